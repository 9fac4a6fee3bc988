"""Slow and simple answers that the operators must give too."""

import re


def words(text):
    """Words of a text, ASCII letters in lower case."""
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def roots(members, links):
    """The smallest member that each member reaches by the links."""
    found = {m: m for m in members}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(found[a], found[b])
            if (found[a], found[b]) != (low, low):
                found[a] = found[b] = low
                changed = True
    return found
