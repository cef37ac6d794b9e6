"""Scenario, template and prompt texts per loan, and parsing of review replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions import vocab
from loanframe.functions.fields import lookup, quoted


def scenario(df: DataFrame) -> Column:
    """Scene name, else the scene label, else the risk label, else the default."""
    names = list(vocab.SCENE_NAMES.values())
    found = []
    if "postloan_scene_label_name" in df.columns:
        name = F.btrim(quoted("postloan_scene_label_name"))
        found.append(F.when(name.isin(names), name))
    if "postloan_scene_label" in df.columns:
        found.append(lookup(quoted("postloan_scene_label"), vocab.SCENE_NAMES))
    risk = next((quoted(c) for c in ("preloan_risk_label", "risk_label") if c in df.columns), F.lit(0))
    found.append(lookup(F.coalesce(risk, F.lit(0)), vocab.SCENE_NAMES))
    return F.coalesce(*found, F.lit(vocab.SCENE_NAMES[vocab.DEFAULT_SCENE]))


def _amount_text(amount: Column) -> Column:
    """A number as text; doubles of ten million and more are written out, where a plain cast gives an exponent."""
    digits = F.regexp_replace(amount.cast("decimal(38,6)").cast("string"), "0+$", "")
    spelled = F.regexp_replace(digits, "\\.$", ".0")
    large = (F.typeof(amount) == "double") & (F.abs(amount) >= 1e7) & (F.abs(amount) < 1e16)
    return F.when(large, spelled).otherwise(amount.cast("string"))


def strategy_text(scene: Column, limit: Column) -> Column:
    """Fixed text per scenario with the approved limit filled in."""
    amount = F.coalesce(_amount_text(limit), F.lit("待定"))
    out = F
    for name, text in vocab.STRATEGY_TEXTS.items():
        head, mark, tail = text.partition("{limit}")
        filled = F.concat(F.lit(head), amount, F.lit(tail)) if mark else F.lit(text)
        out = out.when(scene == name, filled)
    return out


def with_strategy(df: DataFrame, limit: str) -> DataFrame:
    staged = df.withColumn("strategy_scenario", scenario(df))
    return staged.withColumns({
        "strategy_content": strategy_text(F.col("strategy_scenario"), quoted(limit)),
        "strategy_source": F.lit("local_fallback"),
    })


def prompt(df: DataFrame, profile: list[str], scene: str = "strategy_scenario") -> Column:
    """Prompt text: task of the scenario, red lines, output rules, profile as JSON."""
    facts = F.to_json(F.struct(*[quoted(c).alias(c) for c in profile]), {"pretty": "true"})
    return F.concat(
        lookup_text(quoted(scene), vocab.PROMPT_TEXTS), F.lit(f"\n\n{vocab.RED_LINES}\n\n{vocab.OUTPUT_RULES}\n\n"),
        F.lit(f"{vocab.PROFILE_HEADING}\n"), facts,
    )


def lookup_text(key: Column, texts: dict[str, str]) -> Column:
    out = F
    for name, text in texts.items():
        out = out.when(key == name, text)
    return out


def reviewed_text(original: Column, reply: Column) -> Column:
    """Revised text of a JSON reply; the original when there is none.

    The payload is everything from the first to the last brace, whatever
    stands around it.
    """
    payload = F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)(\{.*\})", 1)
    revised = F.btrim(F.get_json_object(payload, "$.revised_content"), F.lit(" \t\n\r"))
    return F.coalesce(F.when(revised != "", revised), original)
