"""Texts that a rule's pattern matches, one for every alternative, made from the pattern itself."""

from itertools import product
from re import _parser as parser


def samples(pattern, most=400):
    """Texts for all alternatives and optional parts of a pattern; repeats are taken at their least and most (up to two)."""
    return list(dict.fromkeys(_texts(parser.parse(pattern))))[:most]


def _texts(nodes):
    return ["".join(parts) for parts in product(*[_of(op, value) for op, value in nodes])]


def _of(op, value):
    name = str(op)
    if name == "LITERAL":
        return [chr(value)]
    if name == "BRANCH":
        return [t for branch in value[1] for t in _texts(branch)]
    if name == "SUBPATTERN":
        return _texts(value[3])
    if name in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = value
        return ["".join(p) for times in dict.fromkeys((low, min(high, max(low, 2 if high > 2 else high)))) for p in product(_texts(inner), repeat=times)]
    if name == "IN":
        if str(value[0][0]) == "NEGATE":
            return ["x"]
        return [c for o, v in value for c in _of(o, v)]
    if name == "RANGE":
        return [chr(value[0])]
    if name == "CATEGORY":
        return {"CATEGORY_DIGIT": ["7"], "CATEGORY_SPACE": [" "]}.get(str(value), ["x"])
    return [""]  # boundaries and look-arounds
