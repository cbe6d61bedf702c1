"""Personal data by weak supervision.

Regular expressions propose spans.  Five labelers vote on each: the strict pattern, the
validity of its numbers, a gazetteer of plausible values, cue words before it, and words
that speak against it.  Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is for each kind, without labels; its posteriors then
train a naive Bayes classifier of votes and shape, which decides on the spans that no
strict pattern covers.  Spans of the strict patterns are kept in any case.

Built-in column functions only: one pass over the texts, one small aggregation over vote
patterns, and one row of parameters per kind.

Null and empty texts have no spans.  Places are code points, ends exclusive.  Texts are
read whole; patterns move on in proportion to the text's length.  Rows are searched one
by one, so repeated rows repeat their result, and an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

KINDS = ["email", "ip", "card", "phone"]

# The strict patterns, their number limits, and word lists.  Possessive
# runs and the looks behind only keep a failed run from being tried again at each of its
# characters; what matches is the same.
_LOCAL = "A-Za-z0-9._%+-"
STRICT = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?: ?(?:\(dot\)|\[dot\]|\[\.\]|\(\.\)) ?[0-9]{1,3}+){3}",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])",
}
NEEDS = {"email": "[@]|[(\\[ ]at[)\\] ]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
DOMAINS = "com|org|net|edu|gov|io|de|fr|es|uk|eu|info|biz"
CUES = {
    "email": "e-?mail|mail|contact|write|correo|courriel",
    "ip": "ip|host|server|address|login|client",
    "card": "card|visa|mastercard|amex|credit|pay|tarjeta|carte|karte",
    "phone": "phone|tel|call|mobile|cell|fax|t[eé]l[eé]fono|anruf",
}
AGAINST = r"version|release|v|no|nr|id|isbn|doi|section|order|ref"
CONTEXT = 24  # characters before a span in which words are looked for

LABELERS = ["strict", "valid", "gazetteer", "cue", "against"]
SHAPES = ["spaced", "marked", "long"]
ROUNDS = 12
MATCH_BLOCK = 256
MATCHES = "array<struct<start: int, end: int, value: string, before: string>>"
ACCEPT = 0.5

SPAN = "struct<start: int, kind: int, end: int, strict: boolean, votes: array<int>, shape: array<int>>"


def _matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their places: the pieces between them give the gaps."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found,
        lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("length"), m.alias("value"), g.alias("before")),
    )
    none = F.array().cast(MATCHES)

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        one = F.struct(
            begin.alias("start"), (begin + x["length"]).alias("end"), x["value"].alias("value"),
            F.right(x["before"], F.lit(CONTEXT)).alias("before"),
        )
        return F.struct((begin + x["length"]).alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    # In blocks, as each step copies what its block has gathered.
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / MATCH_BLOCK).cast("int")),
        lambda k: F.slice(pairs, k * MATCH_BLOCK + 1, F.lit(MATCH_BLOCK)),
    )

    def block_step(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["at"].alias("at"), none.alias("spans")), step)
        return F.struct(done["at"].alias("at"), F.concat(acc["spans"], F.array(done["spans"])).alias("spans"))

    outer = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{MATCHES}>").alias("spans"))
    gathered = F.flatten(F.aggregate(blocks, outer, block_step)["spans"])
    return F.when(F.size(found) > 0, gathered).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(places, F.lit(0), lambda total, i: total + worth(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    """What the strict pattern asks beyond its form."""
    if kind == "ip":
        parts = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))

        def small(part: Column) -> Column:
            plain = F.regexp_replace(part, "^0+", "")
            return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(parts, small)
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lower(value).rlike(rf"(?:\.|dot\)? ?|dot\]? ?)(?:{DOMAINS})$")
    if kind == "ip":
        return ~value.rlike(r"^(?:0|127|255)(?![0-9])")
    if kind == "card":
        return value.rlike("^[3-6]")
    return value.rlike(r"^(?:\+[1-9]|\(?[2-9])")


def _vote(condition: Column, yes: int, no: int) -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def _spans(text: Column, kind: str) -> Column:
    """Spans of a kind, strict ones and loose ones that overlap none of them."""

    def span(m: Column, strict: Column, valid: Column) -> Column:
        before = F.lower(m["before"])
        votes = F.array(
            strict.cast("int"),
            valid.cast("int"),
            _gazetteer(kind, m["value"]).cast("int"),
            _vote(before.rlike(rf"(?<![a-z])(?:{CUES[kind]})\W*$"), 1, -1),
            _vote(before.rlike(rf"(?<![a-z])(?:{AGAINST})\W*$"), 0, -1),
        )
        shape = F.array(
            m["value"].contains(" ").cast("int"),
            m["value"].rlike(r"[()\[\]/_]").cast("int"),
            (m["end"] - m["start"] > 24).cast("int"),
        )
        return F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"),
            strict.alias("strict"), votes.alias("votes"), shape.alias("shape"),
        )

    strict = F.transform(
        F.filter(_matches(text, STRICT[kind]), lambda m: _valid(kind, m["value"])),
        lambda m: span(m, F.lit(True), F.lit(True)),
    )
    loose = F.transform(
        _matches(text, LOOSE[kind]), lambda m: span(m, F.lit(False), _valid(kind, m["value"]))
    )
    empty = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(NEEDS[kind]), F.concat(strict, loose).cast(f"array<{SPAN}>")).otherwise(empty)


def proposed(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the proposed spans with their votes, loose ones clear of strict ones."""
    whole = F.coalesce(F.col(text), F.lit(""))
    step = df.select(*keep, *[_spans(whole, kind).alias(f"_{kind}") for kind in KINDS])
    step = step.select(*keep, F.concat(*[F.col(f"_{kind}") for kind in KINDS]).alias("_all"))
    step = step.withColumn("_strict", F.filter("_all", lambda s: s["strict"]))
    loose = F.filter(
        "_all",
        lambda s: ~s["strict"]
        & ~F.exists("_strict", lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])),
    )
    return step.select(*keep, F.concat("_strict", loose).alias("spans"))


# Expectation-maximisation over the vote patterns of a kind, as one expression: the state
# is the posterior of each pattern.
_SUM = "aggregate(zip_with(patterns, {p}, (x, q) -> {of}), 0D, (a, b) -> a + b)"
_RATES = """transform(sequence(0, {last}), j -> named_struct(
    'yes', (1 + {yes}) / (2 + {yes_all}), 'no', (1 + {no}) / (2 + {no_all})))"""


def _rates(p: str, field: str, last: int) -> str:
    """Share of votes 1 among true and among false spans, per labeler or shape."""
    total = lambda of: _SUM.format(p=p, of=of)
    return _RATES.format(
        last=last,
        yes=total(f"if(x.{field}[j] = 1, x.n * q, 0D)"),
        yes_all=total(f"if(x.{field}[j] >= 0, x.n * q, 0D)"),
        no=total(f"if(x.{field}[j] = 1, x.n * (1 - q), 0D)"),
        no_all=total(f"if(x.{field}[j] >= 0, x.n * (1 - q), 0D)"),
    )


def _odds(votes: str, rates: str) -> str:
    return f"""aggregate(zip_with({votes}, {rates}, (v, r) -> CASE v WHEN 1 THEN ln(r.yes / r.no)
        WHEN 0 THEN ln((1 - r.yes) / (1 - r.no)) ELSE 0D END), 0D, (a, b) -> a + b)"""


def reliabilities(spans: DataFrame) -> DataFrame:
    """Per kind: the prior and the rates of the labelers and shapes, one row each."""
    one = spans.select(F.explode("spans").alias("s"))
    patterns = one.groupBy("s.kind", "s.votes", "s.shape").agg(F.count("*").cast("double").alias("n"))
    kinds = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "shape", "n"))).alias("patterns"))
    first = """transform(patterns, x -> (0.5D + size(filter(x.votes, v -> v = 1)))
        / (1 + size(filter(x.votes, v -> v >= 0))))"""
    prior = f"(1 + {_SUM.format(p='p', of='x.n * q')}) / (2 + {_SUM.format(p='p', of='x.n')})"
    step = f"""transform(array(named_struct('rates', {_rates("p", "votes", len(LABELERS) - 1)}, 'prior', {prior})),
        m -> transform(patterns, x -> 1 / (1 + exp(-(ln(m.prior / (1 - m.prior)) + {_odds("x.votes", "m.rates")})))))[0]"""
    done = kinds.withColumn("p", F.expr(f"aggregate(sequence(1, {ROUNDS}), {first}, (p, i) -> {step})"))
    return done.select(
        "kind",
        F.expr(prior).alias("prior"),
        F.expr(_rates("p", "votes", len(LABELERS) - 1)).alias("labelers"),
        F.expr(_rates("p", "shape", len(SHAPES) - 1)).alias("shapes"),
    )


def _literal(rates: list) -> str:
    return "array(" + ", ".join(f"named_struct('yes', {r.yes!r}D, 'no', {r.no!r}D)" for r in rates) + ")"


def classified(spans: DataFrame) -> DataFrame:
    """``spans`` with the accepted ones in ``found``, by start and kind."""
    models = {row.kind: row for row in reliabilities(spans).collect()}  # one row per kind
    score = "CASE s.kind"
    for kind, m in sorted(models.items()):
        odds = f"ln({m.prior!r}D / (1 - {m.prior!r}D)) + {_odds('s.votes', _literal(m.labelers))} + {_odds('s.shape', _literal(m.shapes))}"
        score += f" WHEN {kind} THEN 1 / (1 + exp(-({odds})))"
    score += " ELSE 0D END" if models else " WHEN -1 THEN 0D ELSE 0D END"
    return spans.withColumn("found", F.array_sort(F.expr(f"filter(spans, s -> s.strict OR {score} >= {ACCEPT}D)")))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, counts of strict spans, base_sha256 of their list, all spans."""
    rows = proposed(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    found = classified(stored(rows, "spans"))
    strict = F.filter("found", lambda s: s["strict"])

    def number(kind: str) -> Column:
        return F.size(F.filter(strict, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in KINDS],
        F.sha2(_listed(strict), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each span in its texts replaced by its kind, such as ``<EMAIL>``."""
    columns = df.columns
    # All columns pass the spans' store, so that texts are searched once.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text).alias("text"))
    found = classified(stored(proposed(rows, keep=("row",)), "spans"))
    places = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    whole = F.col("row").getField(text)

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(whole, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        put = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.get(places, s["kind"]))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), put.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate("found", start, step)
    new = F.when(F.size("found") == 0, whole).otherwise(
        F.concat(done["out"], F.substring(whole, done["at"] + 1, F.length(whole)))
    )
    return found.select(*[new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns])
