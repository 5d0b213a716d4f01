"""Ordered rules compiled to one CASE expression.

The first rule that holds wins. A comparison with NULL does not hold, so a NULL operand
falls through to the default, unless a rule asks for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col


def classify(rules: Iterable[tuple[Column, object]], default=None) -> Column:
    expr = None
    for predicate, label in rules:
        label = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(predicate, label) if expr is None else expr.when(predicate, label)
    if expr is None:
        return F.lit(default)
    return expr if default is None else expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def above(value, steps: Sequence[tuple[float, object]], default=None, null_label=None) -> Column:
    """Label of the first step that ``value`` exceeds; steps go from high to low."""
    x = as_col(value)
    rules = [(x > bound, label) for bound, label in steps]
    if null_label is not None:
        rules.append((x.isNull(), null_label))
    return classify(rules, default)


def at_least(value, steps: Sequence[tuple[float, object]], default=None) -> Column:
    x = as_col(value)
    return classify([(x >= bound, label) for bound, label in steps], default)


def below(value, steps: Sequence[tuple[float, object]], default=None) -> Column:
    x = as_col(value)
    return classify([(x < bound, label) for bound, label in steps], default)


def at_most(value, steps: Sequence[tuple[float, object]], default=None) -> Column:
    x = as_col(value)
    return classify([(x <= bound, label) for bound, label in steps], default)


def one_of(value, groups: Mapping[object, Sequence], default=None) -> Column:
    """Label whose member list holds ``value``."""
    x = as_col(value)
    return classify([(x.isin(list(members)), label) for label, members in groups.items()], default)


def contains_any(value, groups: Mapping[object, Sequence[str]], default=None) -> Column:
    """Label of the first group with a word that occurs in the text."""
    x = as_col(value)

    def any_word(words: Sequence[str]) -> Column:
        hit = x.contains(words[0])
        for word in words[1:]:
            hit = hit | x.contains(word)
        return hit

    return classify([(any_word(words), label) for label, words in groups.items()], default)


def lookup(value, table: Mapping[object, object]) -> Column:
    """Constant dictionary; unknown keys give NULL."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.element_at(F.create_map(*pairs), as_col(value))


def relative(value, base, ups: Sequence[tuple[float, str]], downs: Sequence[tuple[float, str]], default: str) -> Column:
    """Compare with multiples of a base: the ups first, then the downs."""
    x, b = as_col(value), as_col(base)
    rules = [(x > b * factor, label) for factor, label in ups]
    rules += [(x < b * factor, label) for factor, label in downs]
    return classify(rules, default)
