"""Secret scans: patterns, and character Markov models of random strings against ordinary identifiers.

Three patterns give base spans. Beyond them, long tokens of the letters, digits and signs of which keys
are made are scored by two first-order Markov chains over characters: one of random strings, one of
ordinary identifiers. A token whose log-likelihood ratio per character is high enough is a further
span, of kind ``markov``, unless it touches a base span.

Both chains are counted from labelled samples of the corpus itself: what the patterns found is random,
other tokens of its length class are ordinary. The samples are the rows
with the least hashes, about ``SAMPLE_TEXTS`` and ``SAMPLE_RANDOM`` of them, a bound on the fit alone;
every text is scanned whole. The
table of log ratios has a fixed size and travels as a literal.

Positions are counted in code points, the end exclusive. Defined results: a null or empty text has no
spans; without any base span the random chain is uniform; repeated rows are scanned alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lake_ingest.llm.shared import sampled, saved

# The base patterns, each with the group that is measured and its least length.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "markov")

# What a scored token is made of, and its least length.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{8,}"
SAMPLE_TEXTS = 2000
SAMPLE_RANDOM = 20000
MIN_RATIO = 0.5


SPAN = "struct<start:int,kind:int,end:int,value:string>"
# Matches are put together in pieces of this size, so that very many in one text cost little more than few.
PIECE = 256


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def spans(text: str, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of ``(start, kind, end, value)`` of the matches whose group is long enough, by start.

    What lies between the matches gives their places: a match starts where the pieces and matches
    before it end. A text without a match costs one search.
    """
    body, p = F.col(text), F.lit(pattern)
    whole = F.regexp_extract_all(body, p, F.lit(0))
    value = F.regexp_extract_all(body, p, F.lit(group)) if group else whole
    between = F.slice(F.split(body, pattern, -1), F.lit(1), F.size(whole))
    matches = F.arrays_zip(whole.alias("m"), value.alias("v"), between.alias("p"))

    def step(state, x):
        start = state["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), x["v"].alias("value"))
        grown = F.concat(state["spans"], F.array(span.cast(SPAN)))
        return F.struct(
            end.alias("at"), F.when(F.length(x["v"]) >= least, grown).otherwise(state["spans"]).alias("spans")
        )

    def piece(state, i):
        inner = F.aggregate(
            F.slice(matches, i * PIECE + 1, F.lit(PIECE)),
            F.struct(state["at"].alias("at"), _none().alias("spans")),
            step,
        )
        return F.struct(inner["at"].alias("at"), F.concat(state["spans"], inner["spans"]).alias("spans"))

    pieces = F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / PIECE).cast("int"))
    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), _none().alias("spans")), piece)["spans"]
    return F.when(F.rlike(body, p), found).otherwise(_none())


def base_spans(text: str) -> Column:
    """The base spans, by start and then kind.

    A run of one character class is found whole wherever it starts, so the least length may stand in
    the pattern for ``access`` and ``hex``; for ``assign`` a match that is too short still uses up its text.
    """
    return F.array_sort(
        F.concat(
            spans(text, ASSIGN, "assign", 2, LEAST["assign"]),
            spans(text, ACCESS.replace("+", "{%d,}" % (LEAST["access"] - 4)), "access"),
            spans(text, HEX.replace("+", "{%d,}" % LEAST["hex"]), "hex"),
        )
    )


def _places(token: Column) -> Column:
    """Places of a token's characters in the alphabet."""
    return F.transform(F.split(token, "", -1), lambda c: F.instr(F.lit(ALPHABET), c))


def _pairs(token: Column) -> Column:
    """Codes of the pairs of neighbouring characters of a token."""
    width = len(ALPHABET) + 1
    at = F.filter(_places(token), lambda x: x > 0)
    after = F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0)))
    return F.zip_with(F.slice(at, F.lit(1), F.size(after)), after, lambda a, b: a * width + b)


def _pair_counts(tokens: DataFrame) -> dict[int, int]:
    """Counts of the pairs, at most as many as the alphabet has."""
    pairs = tokens.select(F.explode(_pairs(F.col("token"))).alias("pair"))
    return {r.pair: r.n for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect()}


def log_ratios(random: dict[int, int], ordinary: dict[int, int]) -> list[float]:
    """Per pair of characters the logarithm of P(random) / P(ordinary).

    The random chain is half uniform, so that keys over more characters than the labelled ones count
    as random too; the ordinary chain is smoothed by half a pair each.
    """
    width = len(ALPHABET) + 1
    table = [0.0] * (width * width)
    for a in range(1, width):
        row = range(a * width + 1, a * width + width)
        n_random, n_ordinary = (sum(t.get(i, 0) for i in row) for t in (random, ordinary))
        for i in row:
            uniform = 1 / (width - 1)
            p = uniform / 2 + (random.get(i, 0) / n_random if n_random else uniform) / 2
            q = (ordinary.get(i, 0) + 0.5) / (n_ordinary + 0.5 * (width - 1))
            table[i] = round(math.log(p / q), 6)
    return table


def fit(docs: DataFrame, based: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[float]:
    """The table of log ratios, from labelled samples of bounded size.

    Random are the values of base spans, ordinary the other tokens of sampled texts.
    """
    values = based.select(F.explode("_base.value").alias("token"))
    random = sampled(values, ["token"], values.count(), SAMPLE_RANDOM)
    texts = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    sample = sampled(texts.where("text IS NOT NULL"), ["doc_id", "text"], docs.count(), SAMPLE_TEXTS)
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|[0-9a-f]{{{LEAST['hex']},}}", " ")
    ordinary = sample.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("token"))
    return log_ratios(_pair_counts(random), _pair_counts(ordinary))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, base, extra)``: arrays of ``(start, kind, end, value)``, ``extra`` those that the chains add."""
    body = F.coalesce(F.col(text), F.lit("")).alias("_text")
    tokens = spans("_text", TOKEN, "markov")
    found = saved(
        docs.select(F.col(doc_id).alias("doc_id"), body).select(
            "doc_id", base_spans("_text").alias("_base"), tokens.alias("_tokens")
        ),
        "spans",
    )
    table = fit(docs, found, doc_id, text)

    def ratio(token: Column) -> Column:
        scores = F.transform(_pairs(token), lambda pair: F.get(F.lit(table), pair))
        return F.aggregate(scores, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(scores), F.lit(1))

    likely = F.filter("_tokens", lambda t: ratio(t["value"]) >= MIN_RATIO)
    apart = F.filter(
        "_likely",
        lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    return found.withColumn("_likely", likely).select("doc_id", F.col("_base").alias("base"), apart.alias("extra"))


def joined(spans_column: str) -> Column:
    """``kind:start:end`` of each span, by start and then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans_column),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def digest(scanned: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``."""
    counted = {
        f"n_{kind}": F.expr(f"CAST(size(filter(base, s -> s.kind = {i})) AS bigint)")
        for i, kind in enumerate(KINDS[:3])
    }
    return (
        scanned.withColumns(counted)
        .withColumn("_all", F.concat("base", "extra"))
        .select("doc_id", *counted, F.sha2(joined("base"), 256).alias("base_sha256"), joined("_all").alias("spans"))
    )
