"""Whether two path patterns can match one path: the intersection of their automata, before any file is listed."""

from __future__ import annotations

from collections.abc import Sequence

#: A token: a character, a set of them (negated or not), one of any, or any number of any.
_ANY, _MANY = "any", "many"


def tokens(pattern: str) -> list:
    """The tokens of a pattern as files are matched: * and ? take any character, a bracket one of its set, ! negates; an open bracket that is never closed stands for itself."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            if not out or out[-1] != _MANY:
                out.append(_MANY)
        elif c == "?":
            out.append(_ANY)
        elif c == "[":
            j = i + (pattern[i : i + 1] == "!")
            end = pattern.find("]", j + 1)
            if end < 0:
                out.append(("in", frozenset("[")))
                continue
            held, chars, k = pattern[j:end], set(), 0
            while k < len(held):
                if k + 2 < len(held) and held[k + 1] == "-":
                    chars |= {chr(x) for x in range(ord(held[k]), ord(held[k + 2]) + 1)}
                    k += 3
                else:
                    chars.add(held[k])
                    k += 1
            out.append(("out" if pattern[i] == "!" else "in", frozenset(chars)))
            i = end + 1
        else:
            out.append(("in", frozenset(c)))
    return out


def _meet(a, b) -> bool:
    """Whether one character fits both tokens, neither of which is of many."""
    if _ANY in (a, b):
        other = b if a == _ANY else a
        return other == _ANY or other[0] == "out" or bool(other[1])
    if a[0] == b[0] == "in":
        return bool(a[1] & b[1])
    if a[0] == b[0]:
        return True  # two finite sets never leave nothing
    inside, outside = (a, b) if a[0] == "in" else (b, a)
    return bool(inside[1] - outside[1])


def overlap(one: str, other: str) -> bool:
    """Whether some text matches both patterns: pairs of places in them, each visited once."""
    a, b = tokens(one), tokens(other)
    seen, open_ = set(), [(0, 0)]
    while open_:
        i, j = open_.pop()
        if (i, j) in seen:
            continue
        seen.add((i, j))
        if i == len(a) and j == len(b):
            return True
        many_a, many_b = i < len(a) and a[i] == _MANY, j < len(b) and b[j] == _MANY
        if many_a:
            open_.append((i + 1, j))
            if j < len(b) and not many_b:
                open_.append((i, j + 1))  # it takes what the other's token takes
        if many_b:
            open_.append((i, j + 1))
            if i < len(a) and not many_a:
                open_.append((i + 1, j))
        if i < len(a) and j < len(b) and not many_a and not many_b and _meet(a[i], b[j]):
            open_.append((i + 1, j + 1))
    return False


def destinations_overlap(one: str, other: str) -> bool:
    """Whether one of two folders is or lies in the other."""
    a, b = ([p for p in x.strip("/").split("/") if p] for x in (one, other))
    return a[: len(b)] == b or b[: len(a)] == a


def overlapping(roots: Sequence[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(path or destination, one, other) of publish roots (pattern of their paths, destination) that overlap, each pair once. Roots are a configuration, few."""
    found = []
    for i, (paths, to) in enumerate(roots):
        for paths_2, to_2 in roots[:i]:
            if destinations_overlap(to, to_2):
                found.append(("destination", to_2, to))
            if overlap(paths, paths_2):
                found.append(("path", paths_2, paths))
    return found
