"""Rules kept as data: SQL expressions in a table become columns."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

MAX_RULES = 1000


def layers(formulas: dict[str, str]) -> list[list[str]]:
    """Names of the formulas in layers: each needs columns of earlier layers only."""
    needs = {name: {other for other in formulas if re.search(rf"(?<![\w.]){re.escape(other)}(?!\w)", text)} for name, text in formulas.items()}
    done: set[str] = set()
    out: list[list[str]] = []
    while len(done) < len(needs):
        ready = sorted(name for name, wants in needs.items() if name not in done and wants <= done)
        if not ready:
            raise ValueError("rules need each other: " + ", ".join(sorted(set(needs) - done)))
        out.append(ready)
        done.update(ready)
    return out


def add_rule_columns(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Add one column per active rule; a rule may use the columns of others, whatever their order in the table.

    ``rules`` has ``rule_id, adds, formula, in_use``. All rules that can be computed at once share one projection. Of
    rules that add the same column the highest id counts. Rule tables are written by people; more than ``MAX_RULES``
    active rows is refused rather than collected.
    """
    active = rules.where("in_use").select("rule_id", "adds", "formula").limit(MAX_RULES + 1).collect()
    if len(active) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} active rules")
    chosen = {r.adds: r for r in sorted(active)}
    for layer in layers({name: r.formula for name, r in chosen.items()}):
        for name in layer:
            _check(df, chosen[name])
        df = df.withColumns({name: F.expr(chosen[name].formula) for name in layer})
    return df


def _check(df: DataFrame, rule: Row) -> None:
    """Name the rule whose formula the columns at hand cannot answer."""
    try:
        df.select(F.expr(rule.formula)).schema  # noqa: B018  (analysed, not run)
    except AnalysisException as error:
        raise ValueError(f"rule {rule.rule_id} ({rule.adds}) does not compile: {error}") from error
