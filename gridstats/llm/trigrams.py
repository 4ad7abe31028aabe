"""Boolean trigram queries of regular expressions.

``trigram_query`` turns an expression into alternatives, each a set of trigrams: a text can match
only if, for some alternative, it holds all of its trigrams (compared in lower case). An empty
alternative set of trigrams means the expression promises nothing and every text must be scanned.
"""

from __future__ import annotations

import re
from re import _constants as sre
from re import _parser as parser

Query = frozenset[frozenset[str]]

ANY: Query = frozenset([frozenset()])
MOST_STRINGS = 128  # of an exact set before it is closed; a larger set only weakens the query
MOST_CLASS = 16


def trigram_query(regex: str) -> Query:
    query, exact = _walk(parser.parse(regex), ANY, {""})
    return _simplify(_both(query, _of_strings(exact)))


def _of_strings(strings: set[str]) -> Query:
    """Any of the strings, each through the trigrams it consists of."""
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > 4 * MOST_STRINGS:
        return min(a, b, key=len)
    return frozenset(x | y for x in a for y in b)


def _simplify(query: Query) -> Query:
    """Drop alternatives that imply another."""
    return frozenset(x for x in query if not any(y < x for y in query))


def _join(left: set[str], right: set[str]) -> set[str]:
    return {a + b for a in left for b in right}


def _class(items) -> set[str] | None:
    """The characters of a small class in lower case."""
    found: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(chr(value).lower())
        elif kind is sre.RANGE:
            found |= {chr(c).lower() for c in range(value[0], min(value[1], value[0] + 64) + 1)}
        else:
            return None
        if len(found) > MOST_CLASS:
            return None
    return found


def _walk(parts, query: Query, exact: set[str]) -> tuple[Query, set[str]]:
    """Follow a concatenation; ``exact`` holds all strings the open stretch may be."""
    for kind, value in parts:
        options: set[str] | None = None  # what the part may be, if that is a small set
        inner: Query = ANY  # else what it asks for
        if kind is sre.LITERAL:
            options = {chr(value).lower()}
        elif kind is sre.IN:
            options = _class(value)
        elif kind is sre.SUBPATTERN:
            options, inner = _closed(value[3])
        elif kind is sre.BRANCH:
            arms = [_closed(arm) for arm in value[1]]
            if all(o is not None for o, _ in arms):
                options = set().union(*(o for o, _ in arms))
            else:
                inner = frozenset().union(*(q if o is None else _of_strings(o) for o, q in arms))
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = value
            strings, asks = _closed(body)
            if strings is not None and most == 1:
                options = strings | {""} if least == 0 else strings
            elif strings is not None and least == most and least <= 4:
                options = {""}
                for _ in range(least):
                    options = _join(options, strings)
                    if len(options) > MOST_STRINGS:
                        options = None
                        break
            elif least >= 1:
                inner = _of_strings(strings) if strings is not None else asks
        elif kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            options = {""}
        if options is not None and len(exact) * len(options) <= MOST_STRINGS:
            exact = _join(exact, options)
            continue
        query = _both(query, _of_strings(exact))
        if options is not None:
            exact = options
        else:
            query = _both(query, inner)
            exact = {""}
    return query, exact


def _closed(parts) -> tuple[set[str] | None, Query]:
    query, exact = _walk(parts, ANY, {""})
    plain = query == ANY and all(_exactly(p) for p in parts)
    return (exact, ANY) if plain else (None, _simplify(_both(query, _of_strings(exact))))


def _exactly(part) -> bool:
    """Whether the open stretch of ``_walk`` kept this part whole."""
    kind, value = part
    if kind is sre.LITERAL or kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return True
    if kind is sre.IN:
        return _class(value) is not None
    if kind is sre.SUBPATTERN:
        return _closed(value[3])[0] is not None
    if kind is sre.BRANCH:
        return all(_closed(arm)[0] is not None for arm in value[1])
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = value
        return most <= 4 and (most == 1 or least == most) and _closed(body)[0] is not None
    return False


def holds(query: Query, text: str) -> bool:
    """Whether a text passes; for tests and small use."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return any(all(t in text for t in alternative) for alternative in query)
