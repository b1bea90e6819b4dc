"""Boolean trigram queries of regular expressions.

``trigram_query`` gives a conjunction of clauses; a clause is a set of
alternatives, each a set of trigrams that must all occur. A text that does not
satisfy it cannot match. An empty conjunction says nothing, and the rule has to scan
every text. Queries are in lower case and hold for any case of a text.
"""

from __future__ import annotations

import re
from re import _constants as C, _parser as parser

MAX_STRINGS = 24  # alternatives followed exactly
MAX_CLASS = 6  # characters of a class followed exactly

Clause = frozenset[frozenset[str]]


def _class_chars(items) -> set[str] | None:
    out: set[str] = set()
    for op, value in items:
        if op is C.LITERAL:
            out.add(chr(value).lower())
        elif op is C.RANGE and value[1] - value[0] < MAX_CLASS:
            out.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= MAX_CLASS else None


def _exact(op, value) -> set[str] | None:
    """All strings that the node matches, if they are few."""
    if op is C.LITERAL:
        return {chr(value).lower()}
    if op is C.AT:
        return {""}
    if op is C.IN:
        return _class_chars(value)
    if op is C.SUBPATTERN:
        return _exact_sequence(value[-1])
    if op is C.BRANCH:
        parts = [_exact_sequence(p) for p in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[1] <= 2:
        inner = _exact_sequence(value[2])
        if inner is None:
            return None
        powers = [{""}]
        for _ in range(value[1]):
            powers.append({a + b for a in powers[-1] for b in inner})
        return set().union(*powers[value[0] :])
    return None


def _exact_sequence(nodes) -> set[str] | None:
    out = {""}
    for op, value in nodes:
        more = _exact(op, value)
        if more is None or len(out) * len(more) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _clause(strings: set[str]) -> set[Clause]:
    if not strings or min(map(len, strings)) < 3:
        return set()
    terms = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return {frozenset(t for t in terms if not any(o < t for o in terms))}


def _sequence(nodes) -> set[Clause]:
    clauses: set[Clause] = set()
    held = {""}
    for op, value in nodes:
        more = _exact(op, value)
        if more is not None and len(held) * len(more) <= MAX_STRINGS:
            held = {a + b for a in held for b in more}
            continue
        clauses |= _clause(held)
        held = {""}
        if more is not None and len(more) <= MAX_STRINGS:
            held = more
        elif op is C.SUBPATTERN:
            clauses |= _sequence(value[-1])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[0] > 0:
            clauses |= _sequence(value[2])
        elif op is C.BRANCH:
            parts = [_sequence(p) for p in value[1]]
            if all(parts):  # one clause of each branch is enough to say something
                clauses.add(frozenset().union(*[min(p, key=lambda c: (len(c), sorted(map(sorted, c)))) for p in parts]))
    return clauses | _clause(held)


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """Clauses, their alternatives and the trigrams of these, in a fixed order."""
    found = _sequence(parser.parse(pattern, re.DOTALL))
    return sorted(sorted(sorted(t) for t in clause) for clause in found)
