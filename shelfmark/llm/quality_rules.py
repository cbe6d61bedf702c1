"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document.  The ledger keeps the measurements and one
bit per failed rule; policies are versioned sets of rules, applied afterwards by a bit
mask, so a new policy or an ablation never reads the texts again.  Built-in column
functions only, one pass, no shuffle.

Null and empty texts have no words: all measurements are 0 and the base rule fails.
Texts of any length are measured whole.  Repeated rows are measured one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space, counted symbols, and the limits of the base rules.
SPACES = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASUREMENTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words",
    "n_shouted_words", "n_marks",
]


@dataclass(frozen=True)
class Rule:
    """A document fails where ``failed``, over measurements, is true."""

    name: str
    failed: str


RULES = [
    Rule("few_words", f"n_words < {MIN_WORDS}"),
    Rule("repeated_windows", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 6 * n_lines"),
    Rule("shouting", "n_words >= 20 AND 10 * n_shouted_words > 3 * n_words"),
    Rule("many_marks", "10 * n_marks > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
]
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}

POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "many_symbols", "repeated_lines"],
    "v2": [rule.name for rule in RULES],
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _windows(hashes: Column, n: Column) -> Column:
    """A hash for each window of WINDOW words; null in shorter texts."""
    windows = F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))
    )
    return F.when(n >= WINDOW, windows)


def _sorted(windows: Column) -> Column:
    """The windows with their places, equal ones next to each other."""
    places = F.sequence(F.lit(1), F.size(windows))
    return F.sort_array(F.zip_with(windows, places, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))


def measured(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns and the MEASUREMENTS of each row's text."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), "")
    lines = F.filter(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(WORD_CHARACTER)
    )
    step = df.select(
        *[F.col(k) for k in keep], F.col(text).alias("_text"), words.alias("_words"), lines.alias("_lines")
    ).withColumn("_n", F.size("_words"))
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    step = step.withColumn("_windows", _windows(F.col("_hashes"), F.col("_n")))
    repeated = F.size("_windows") > F.size(F.array_distinct("_windows"))
    step = step.withColumn("_sorted", F.when(repeated, _sorted(F.col("_windows"))))
    # Equal windows are neighbours once sorted.
    same = F.zip_with(
        F.slice("_sorted", F.lit(1), F.size("_sorted") - 1),
        F.slice("_sorted", F.lit(2), F.size("_sorted") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
    step = step.withColumn("_places", F.when(F.col("_sorted").isNotNull(), places))
    k = F.size("_places")
    steps = F.zip_with(
        F.slice("_places", F.lit(1), k - 1),
        F.slice("_places", F.lit(2), k - 1),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(steps, F.lit(WINDOW), lambda total, x: total + x)
    shouted = F.regexp_count(F.col("_text"), F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}{2,}(?!\p{Ll})"))
    whole = {
        "n_words": F.col("_n"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count(F.col("_text"), F.lit(SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_lines": F.size("_lines"),
        "n_repeat_words": F.when(F.col("_places").isNotNull(), covered),
        "n_shouted_words": shouted,
        "n_marks": F.regexp_count(F.col("_text"), F.lit(r"!!|\?\?")),
    }
    return step.select(
        *[F.col(k) for k in keep],
        *[F.coalesce(whole[m], F.lit(0)).cast("bigint").alias(m) for m in MEASUREMENTS],
    )


def ledger(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the measurements and ``failures``, one bit per failed rule."""
    bits = [F.when(F.expr(r.failed), F.lit(BIT[r.name])).otherwise(F.lit(0)) for r in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(df, text, keep).withColumn("failures", total.cast("bigint"))


def passes(policy: str, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(mask(policy))) == 0


def ablation(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (and would
    come back without it), and the rules that ever fail together with it."""
    bits = F.col("failures").bitwiseAND(F.lit(mask(policy)))
    patterns = ledger_rows.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in POLICIES[policy]])
    )
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.select("bits", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("failed_alone"),
            F.coalesce(F.bit_or(F.when(hit, F.col("bits"))), F.lit(0)).alias("together"),
        )
    )
