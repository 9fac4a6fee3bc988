"""Token ids of whole texts, the same as the tokenizer gives, with words remembered.

The word tokenizer drops white space, so the ids of a text are those of its words one after
the other.  Each word is encoded once and remembered; the new words of many texts are split
into parts, as the tokenizer splits them, and encoded in one go, a line each.  Only words
whose lower case and composition cannot depend on anything else take this path; every other
word goes through the complete tokenizer.  White space here is the ASCII one, so no word has
a line end in it; what other white space a word holds is left to the tokenizer.

The parts are encoded by a second library with the same merges.  It joins the neighbours
whose union has the lowest rank, whatever they are; the tokenizer asks for the pair named in
the merge.  The two agree if every token is what its own text is encoded to, as a test
checks for the vocabulary: a pair of neighbours that spells a token has then gone through
the same merges as that text alone, and so is the pair named.  The end of a part, which the
vocabulary writes into its last character, is a byte that no such part holds.

The memory of a worker is bounded: the table of words starts anew when it is full.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np

TOKENIZER = "word_bpe_49k.json"
REMEMBERED = 500_000  # words per Python worker
TOGETHER = 1 << 20  # bytes of texts whose new words are learned in one go

# Fixed values of the tokenizer: how it splits a word, and how its vocabulary marks an end.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
END = "</w>"

_MARK = "\x01"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _character_bytes() -> dict[str, int]:
    """The byte that each printable character of the vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class WordEncoder:
    """ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED):
        import regex
        from tokenizers import Tokenizer

        path = path or default_path()
        self.tokenizer = Tokenizer.from_file(path)
        self.mark_ends = regex.compile(SPLIT).sub
        # Letters of ASCII and Latin-1: composed already, with a lower case of their own.
        self.is_simple = regex.compile(r"[!-~À-ÖØ-öø-ÿ\n]+").fullmatch
        self.remembered = remembered
        self.words: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as file:
            self._read_merges(json.load(file)["model"])

    def _read_merges(self, model: dict) -> None:
        import tiktoken

        of = _character_bytes()
        mark = _MARK.encode()

        def spelled(token: str) -> bytes:
            body = token.removesuffix(END) if len(token) > len(END) else token
            return bytes(of[c] for c in body) + mark * (body != token)

        single = [spelled(t) for t in model["vocab"] if t in of or (t.endswith(END) and t.removesuffix(END) in of)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # The mark joins its character before anything else does.
        order = sorted(single, key=lambda t: (-len(t), t)) + [spelled(a + b) for a, b in pairs]
        ranks = {token: rank for rank, token in enumerate(dict.fromkeys(order))}
        ranks.setdefault(mark, len(ranks))
        self.line_end = ranks.setdefault(b"\n", len(ranks))
        self.coder = tiktoken.Encoding(
            "parts", pat_str=f"\n|[^{_MARK}\n]+{_MARK}", mergeable_ranks=ranks, special_tokens={}
        )
        self.ids = np.zeros(len(ranks), "<u4")
        for token, number in model["vocab"].items():
            rank = ranks.get(spelled(token)) if all(c in of for c in token.removesuffix(END) or token) else None
            if rank is not None:
                self.ids[rank] = number

    def _learn_simple(self, words: list[bytes], lines: str) -> None:
        marked = self.mark_ends(rf"\g<0>{_MARK}", lines.lower())
        ranks = self.coder.encode_to_numpy(marked + "\n", disallowed_special=())
        line_ends = np.flatnonzero(ranks == self.line_end)
        ids = self.ids[np.delete(ranks, line_ends)].tobytes()
        ends = ((line_ends - np.arange(len(line_ends))) * 4).tolist()
        self.words.update((word, ids[start:end]) for word, start, end in zip(words, [0, *ends], ends, strict=False))

    def _learn(self, words: set[bytes]) -> None:
        simple = list(words)
        lines = b"\n".join(simple).decode("utf-8", "replace")
        if "<|" in lines or not self.is_simple(lines):
            simple, texts = [], []
            for word, text in zip(words, lines.split("\n")):
                if self.is_simple(text) and "<|" not in text:
                    simple.append(word)
                    texts.append(text)
                else:
                    self.words[word] = np.array(
                        self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"
                    ).tobytes()
            lines = "\n".join(texts)
        if simple:
            self._learn_simple(simple, lines)

    def _encode_together(self, texts: list[bytes]) -> list[bytes]:
        split = [text.split() for text in texts]
        new = set().union(*split).difference(self.words)
        if new:
            if len(self.words) + len(new) > self.remembered:
                self.words.clear()
                new = set().union(*split)
            self._learn(new)
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def encode_all(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of every text, in their order."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._encode_together(held)
                held, size = [], 0
        yield from self._encode_together(held)

    def encode(self, text: bytes) -> bytes:
        return self._encode_together([text])[0]


_ENCODERS: dict[str | None, WordEncoder] = {}


def encoder(path: str | None = None) -> WordEncoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
