"""Suffix rules as data."""

from __future__ import annotations

from importlib import resources
from typing import NamedTuple


class Rule(NamedTuple):
    step: int
    suffix: str
    least: int
    replacement: str
    exceptions: list[str]


def suffix_rules(text: str | None = None) -> list[Rule]:
    """Rules in order, from ``text`` or from the table that comes with the package."""
    if text is None:
        text = resources.files("outorga.fixed").joinpath("suffix_rules.txt").read_text("utf-8")
    lines = [line.split() for line in text.splitlines() if line.strip() and not line.startswith("#")]
    return [Rule(int(step), suffix, int(least), "" if repl == "-" else repl, rest)
            for step, suffix, least, repl, *rest in lines]
