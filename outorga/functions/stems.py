"""Tokens and stems as column expressions over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outorga.fixed.rules import Rule, suffix_rules

# Accented character -> plain character.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "aaaaaeeeeiiiiooooouuuucn"


def tokens(text: Column, stop_words: list[str] | None = None, accented: str = ACCENTED, plain: str = PLAIN) -> Column:
    """Lower-case runs of ``a-z`` after accents are replaced, without stop words and single letters."""
    words = F.regexp_extract_all(F.translate(F.lower(text), accented, plain), F.lit("[a-z]+"), 0)
    words = F.filter(words, lambda w: F.length(w) > 1)
    if stop_words:
        stops = F.array(*map(F.lit, stop_words))
        words = F.filter(words, lambda w: ~F.array_contains(stops, w))
    return words


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rule_table(rules: list[Rule]) -> Column:
    """Rules by the last letter of their suffix, in rule order: a literal after constant folding."""
    by_letter: dict[str, list[Rule]] = {}
    for rule in rules:
        by_letter.setdefault(rule.suffix[-1], []).append(rule)

    def entry(r: Rule) -> str:
        exceptions = f"array({', '.join(map(_text, r.exceptions))})" if r.exceptions else "cast(array() as array<string>)"
        return (f"named_struct('suffix', {_text(r.suffix)}, 'cut', {len(r.suffix)}, 'shortest', {len(r.suffix) + r.least}, "
                f"'replacement', {_text(r.replacement)}, 'exceptions', {exceptions})")

    cells = [f"{_text(letter)}, array({', '.join(map(entry, group))})" for letter, group in by_letter.items()]
    return F.expr(f"map({', '.join(cells)})")


def _reduced(word: Column, table: Column) -> Column:
    """The word after the first rule that applies; null if none does."""
    candidates = F.try_element_at(table, F.right(word, F.lit(1)))
    hits = F.filter(candidates, lambda r: (
        word.endswith(r["suffix"])
        & (F.length(word) >= r["shortest"])
        & ~F.array_contains(r["exceptions"], word)))
    cut = F.transform(F.slice(hits, 1, 1), lambda r: F.concat(
        F.left(word, F.length(word) - r["cut"]), r["replacement"]))
    return F.try_element_at(cut, F.lit(1))


def stems(words: Column, rules: list[Rule] | None = None) -> Column:
    """Stem every word of an array: plural, feminine, augmentative, adverb; then the noun suffix,
    or failing that the verb suffix, or failing that the last vowel. Words pass through the steps
    as lambda variables, so the expression stays linear in the number of steps."""
    by_step: dict[int, list[Rule]] = {}
    for rule in suffix_rules() if rules is None else rules:
        by_step.setdefault(rule.step, []).append(rule)
    table = {step: _rule_table(group) for step, group in by_step.items()}
    for group in ((0,), (1,), (3,), (2,), (4, 5, 6)):
        steps = [s for s in group if s in table]
        if steps:
            words = F.transform(words, _one_of([table[s] for s in steps]))
    return words


def _one_of(tables: list[Column]):
    return lambda w: F.coalesce(*[_reduced(w, t) for t in tables], w)
