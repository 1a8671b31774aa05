"""Quality rules: base counts, and the divergence of a text's histograms from those of its language.

Two histograms describe a text: of character classes, and of the words that are common in the corpus.
Both are compared by Jensen-Shannon distance with those of its own language and of every major one, and the
nearest language counts, so that a text with a wrong or missing language loses nothing. A text is kept if its
base counts pass and neither distance is too large; a histogram of too few characters or words is no
evidence, and is not compared.

Major is a language with a hundredth of all words; there are at most a hundred. Every language has a
reference, the sums over its texts; that of a language of fewer than ``MIN_LANGUAGE_WORDS`` words is blended with
the whole corpus, so that a few texts with a label of their own are not their own measure. The common words are
those with the highest share summed over the major languages, and the most frequent ones of each of these, at
most 1,264. The major languages' references are thus bounded, and a value that all tasks read; the others are
joined to the texts of their language, which are few: less than a hundredth of all words each. Texts are read
twice, once to count words and once for the counts of each text, which are written down; everything after that
works on those small rows. Nothing but word counts is shuffled, and those are summed before the shuffle.

Defined results: a null or empty text has no words, fails the base rules and is not kept; a null
language adds to no reference; without any language nothing is compared, and with many languages of which
none is major the corpus is compared with all; repeated rows are judged
alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lake_ingest.functions.keys import quoted
from lake_ingest.llm.shared import saved, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Fixed value: the symbols of the base rules.
SYMBOLS = "#*$%&|<>"

COMMON_WORDS = 64
# So many of its most frequent words each language has among the common ones.
LANGUAGE_WORDS = 12
# First of the code points that stand for the common words in a text's summary.
FIRST_CODE = 0x30
CLASSES = 6
MIN_CHARS = 200
MIN_COMMON = 30
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.64
# Least slots of the table in which a word's code is looked up; of the seeds the one with the fewest
# common words in a slot is taken.
SLOTS = 2048
SEEDS = 128
# The reference of a language with fewer words is blended with the corpus.
MIN_LANGUAGE_WORDS = 5000
# A language is major if it holds one in so many of all words.
MAJOR_PART = 100
PARTS = 64

COUNTS = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count(text: str, drop: str) -> Column:
    """Number of characters left when those of a class are dropped."""
    return F.length(F.regexp_replace(text, drop, "")).cast("long")


def repeat_words(places: str) -> str:
    """SQL of the number of words that lie in 3-word windows starting at the given ascending places."""
    return f"""coalesce(aggregate(
        zip_with({places}, slice({places}, 2, greatest(size({places}) - 1, 0)),
            (a, b) -> least(3, coalesce(b - a, 3))),
        0L, (total, step) -> total + step), 0L)"""


def measured(docs: DataFrame, text: str, *carried: Column) -> DataFrame:
    """``carried`` with the base counts, the character classes and the words ``_w`` of each text."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(*carried, body.alias("_body"), F.split(body, "\n", -1).alias("_lines")).withColumns(
        {"_w": words("_body"), "_lines": F.expr(r"filter(_lines, l -> l RLIKE '[^\\x20\\x09-\\x0D]')")}
    )
    prints = split.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "_compact": F.array_join("_w", ""),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_prints": F.expr(
                """if(size(_w) < 3, CAST(array() AS array<bigint>),
                    transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])))"""
            ),
        }
    )
    # Window and place in one number, the place in the low bits: sorted, equal windows are neighbours.
    placed = prints.withColumns(
        {
            "_again": F.size(F.array_distinct("_prints")) < F.size("_prints"),
            "_low": F.expr("shiftleft(1L, CAST(ceil(log2(size(_prints) + 2)) AS int)) - 1"),
        }
    ).withColumn(
        "_sorted",
        F.expr(
            """if(_again, sort_array(transform(_prints, (h, i) -> (h & ~_low) | i)),
                CAST(array() AS array<bigint>))"""
        ),
    )
    # A run of equal high bits holds a repeated window if a neighbour's whole fingerprint is equal.
    repeated = placed.withColumn(
        "_places",
        F.expr(
            """array_sort(flatten(transform(filter(
                zip_with(_sorted, slice(_sorted, 2, greatest(size(_sorted) - 1, 0)), (a, b) ->
                    if((a & ~_low) = (b & ~_low), struct(CAST(a & _low AS int) AS a, CAST(b & _low AS int) AS b),
                        NULL)),
                x -> x IS NOT NULL AND _prints[x.a] = _prints[x.b]), x -> array(x.a, x.b))))"""
        ),
    ).withColumn("_places", F.array_distinct("_places"))
    rest = F.regexp_replace("_compact", r"[a-zß-ÿ]+", "")
    return (
        repeated.withColumn("_rest", rest)
        .withColumns(
            {
                "word_chars": F.length("_compact").cast("long"),
                "n_symbols": _count("_rest", r"[^#*$%&|<>]+"),
                "n_repeat_words": F.expr(repeat_words("_places")),
                "_upper": _count("_rest", r"[^\p{Lu}]+"),
                "_digits": _count("_rest", r"[^0-9]+"),
                "_marks": _count("_rest", r"[^!-/:-@\[-`{-~]+"),
                "_spaces": (F.length("_body") - F.length("_compact")).cast("long"),
            }
        )
        .drop("_prints", "_sorted", "_again", "_low", "_places", "_lines", "_rest")
    )


def char_classes() -> Column:
    """Histogram: capitals, digits, symbols, other marks, white space, others."""
    return F.expr(
        """array(_upper, _digits, n_symbols, _marks - n_symbols, _spaces,
            word_chars - _upper - _digits - _marks)"""
    )


def language_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``(lang, word, n)`` over all texts that have a language."""
    return (
        docs.where(F.col(lang).isNotNull())
        .select(F.col(lang).cast("string").alias("lang"), F.explode(words(text)).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )


def major_languages(counts: DataFrame) -> tuple[dict[str, int], int]:
    """Languages with a hundredth of all words, which are at most a hundred, with their words; and all words."""
    sums = counts.groupBy("lang").agg(F.sum("n").alias("words"))
    whole = sums.agg(F.sum("words").alias("words")).first().words or 0
    return {r.lang: r.words for r in sums.where(F.col("words") * MAJOR_PART >= whole).collect()}, whole


def common_words(counts: DataFrame, k: int = COMMON_WORDS, each: int = LANGUAGE_WORDS) -> DataFrame:
    """The ``k`` words with the highest share summed over the major languages and the first ``each`` of each.

    ``(word, code, total)``, with the word's number in all languages. A language of few words is filled up
    with words of the corpus.
    """
    spark = counts.sparkSession
    majors, whole = major_languages(counts)
    lacks = {lang: max(0.0, 1 - n / MIN_LANGUAGE_WORDS) for lang, n in majors.items()}

    def of_language(values: dict) -> Column:
        return F.create_map(*(F.lit(x) for item in values.items() for x in item))[F.col("lang")]

    ours = counts.where(F.col("lang").isin(*majors))
    held = of_language({lang: max(n, MIN_LANGUAGE_WORDS) for lang, n in majors.items()}) if majors else F.lit(1)
    corpus = F.col("total") / (whole or 1)
    per_word = saved(
        counts.withColumn("_held", F.when(F.col("lang").isin(*majors), held))
        .groupBy("word")
        .agg(F.coalesce(F.sum(F.col("n") / F.col("_held")), F.lit(0.0)).alias("share"), F.sum("n").alias("total"))
        .withColumn("share", F.col("share") + corpus * (sum(lacks.values()) if majors else 1.0)),
        "per-word",
    )
    own = ours.withColumn("own", F.col("n") / held)
    if any(lacks.values()):
        frequent = per_word.orderBy(F.desc("total"), "word").limit(each).collect()
        filled = spark.createDataFrame(
            [(lang, r.word, 0) for lang, lack in lacks.items() if lack for r in frequent], "lang string, word string, n long"
        )
        own = (
            ours.unionByName(filled)
            .groupBy("lang", "word")
            .agg(F.sum("n").alias("n"))
            .join(per_word.select("word", "total"), "word")
            .withColumn("own", F.col("n") / held + of_language(lacks) * corpus)
        )
    # A language may hold most words: its first ones are found among those of each of its parts.
    order = [F.round("own", 9).desc(), "word"]
    firsts = own.withColumn("_part", F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    for keys in (["lang", "_part"], ["lang"]):
        firsts = firsts.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        firsts = firsts.where(F.col("_place") <= each)
    order = [F.round("share", 9).desc(), "word"]
    chosen = per_word.orderBy(*order).limit(k).select("word").unionByName(firsts.select("word")).distinct()
    return per_word.join(chosen, "word").select(
        "word", (F.row_number().over(Window.orderBy(*order)) - 1).alias("code"), "total"
    )


def _character(code: int) -> str:
    """The character of a common word; surrogates are left out."""
    point = FIRST_CODE + code
    return chr(point if point < 0xD800 else point + 0x800)


def word_codes(common: DataFrame, words_column: str) -> Column:
    """Text with one character per common word of a text, in its order.

    A word is looked up by its hash in a few tables of slots, as many as the fullest slot has common words.
    """
    slots = max(SLOTS, 4 * common.count())
    placed = common.select(
        "word", "code", F.explode(F.sequence(F.lit(0), F.lit(SEEDS - 1))).alias("seed")
    ).withColumn("slot", F.pmod(F.xxhash64("word", "seed"), F.lit(slots)).cast("int"))
    best = (
        placed.groupBy("seed", "slot")
        .agg(F.count("*").alias("n"))
        .groupBy("seed")
        .agg(F.max("n").alias("tables"))
        .orderBy("tables", "seed")
        .first()
    )
    if best is None:
        return F.lit("")
    tables = [([""] * slots, [""] * slots) for _ in range(best.tables)]
    for entry in placed.where(F.col("seed") == best.seed).orderBy("code").collect():
        held, named = next(t for t in tables if not t[0][entry.slot])
        held[entry.slot], named[entry.slot] = entry.word, _character(entry.code)

    def literal(values: list[str]) -> Column:
        return F.split(F.lit(" ".join(values)), " ", -1)

    def code(word: Column) -> Column:
        at = F.pmod(F.xxhash64(word, F.lit(best.seed)), F.lit(slots)).cast("int")
        found = F.lit("")
        for held, named in reversed(tables):
            found = F.when(F.get(literal(held), at) == word, F.get(literal(named), at)).otherwise(found)
        return found

    return F.array_join(F.transform(words_column, code), "")


def code_counts(codes: str) -> Column:
    """Number of each common word that occurs, ``(code, n)``, from the text of their codes."""
    return F.expr(
        f"""transform(array_distinct(split({codes}, '')), c -> struct(
            ascii(c) - {FIRST_CODE} - if(ascii(c) < {0xD800}, 0, {0x800}) AS code,
            CAST(length({codes}) - length(replace({codes}, c, '')) AS bigint) AS n))"""
    )


def distance(counts: str, total: str, reference: str) -> str:
    """SQL of the Jensen-Shannon distance (base 2) of counts with a given sum to an array of shares."""
    return f"""sqrt(greatest(0D, aggregate(zip_with({counts}, {reference}, (x, q) ->
        if(x > 0, x / {total} * log2(2 * x / (x + q * {total})), 0D)
            + if(q > 0, q * log2(2 * q * {total} / (x + q * {total})), 0D)),
        0D, (s, x) -> s + x) / 2))"""


def word_distance(counts: str, total: str, reference: str) -> str:
    """``distance`` of the counts ``(code, n)`` of the words that occur; others add their share."""
    q = f"{reference}[x.code]"
    return f"""sqrt(greatest(0D, aggregate({counts}, 1D, (s, x) -> s
        + x.n / {total} * log2(2 * x.n / (x.n + {q} * {total}))
        + if({q} > 0, {q} * log2(2 * {q} * {total} / (x.n + {q} * {total})) - {q}, 0D)) / 2))"""


def references(features: DataFrame, counts: DataFrame, common: DataFrame) -> DataFrame:
    """``(lang, chars, words)``: of every language with words its shares of character classes and common words.

    A small language's shares are blended with the corpus's, the more so the fewer words it has. The row with
    a null language is the corpus.
    """
    classes = (
        features.where("lang IS NOT NULL")
        .groupBy("lang")
        .agg(F.sum("n_words").alias("all"), F.array(*(F.sum(F.col("_classes")[i]) for i in range(CLASSES))).alias("own"))
        .where(F.col("all") > 0)
    )
    # A language's counts of the common words, of which there are at most some thousand.
    found = (
        counts.join(common, "word")
        .groupBy("lang")
        .agg(F.map_from_entries(F.collect_list(F.struct("code", "n"))).alias("found"), F.sum("n").alias("mine"))
    )
    whole = classes.agg(F.array(*(F.sum(F.col("own")[i]) for i in range(CLASSES))).alias("whole"))
    totals = common.agg(F.array_sort(F.collect_list(F.struct("code", "total")))["total"].alias("totals"))
    corpus = totals.select(F.lit(None).cast("string").alias("lang"), F.lit(0).cast("long").alias("all"))
    shares = "transform({0}, x -> x / aggregate({0}, 0L, (s, z) -> s + z))"
    return (
        classes.unionByName(corpus, allowMissingColumns=True)
        .join(found, "lang", "left")
        .withColumns({"_whole": whole.scalar(), "_totals": totals.scalar()})
        .withColumns({"_whole": F.expr(shares.format("_whole")), "_totals": F.expr(shares.format("_totals"))})
        .withColumn("weight", F.least(F.lit(1.0), F.sqrt(F.col("all") / MIN_LANGUAGE_WORDS)))
        .select(
            "lang",
            F.expr(
                """transform(_whole, (y, i) -> if(lang IS NULL, y,
                    weight * own[i] / aggregate(own, 0L, (s, z) -> s + z) + (1 - weight) * y))"""
            ).alias("chars"),
            F.expr(
                """transform(_totals, (y, i) -> if(mine IS NULL, y,
                    weight * coalesce(try_element_at(found, i), 0L) / mine + (1 - weight) * y))"""
            ).alias("words"),
        )
    )


def _judged(docs: DataFrame, carried: list[Column], text: str, lang: str) -> DataFrame:
    """``carried`` with the counts, distances and verdict of each row.

    The distances are null where they were not measured: for texts that fail the base rules or are too
    short, and without any language.
    """
    counts = saved(language_words(docs, text, lang), "words")
    common = saved(common_words(counts), "common")
    known = F.col(lang).cast("string").alias("lang")
    features = saved(
        measured(docs, text, F.struct(*carried).alias("_row"), known)
        .select(
            "_row",
            "lang",
            "n_words",
            *COUNTS,
            char_classes().alias("_classes"),
            F.expr("word_chars + _spaces").alias("_chars"),
            word_codes(common, "_w").alias("_codes"),
        ).select("*", F.length("_codes").cast("long").alias("_common"), code_counts("_codes").alias("_counts")).drop("_codes"),
        "features",
    )
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")

    enough = {"char": F.col("_chars") >= MIN_CHARS, "word": F.col("_common") >= MIN_COMMON}
    majors, _ = major_languages(counts)
    known_languages = saved(references(features, counts, common), "references")
    # The major languages, at most a hundred, or else the corpus: a value that all tasks read.
    compared = F.col("lang").isin(*majors) if majors else F.col("lang").isNull()
    nearest = known_languages.where(compared & F.expr("chars[0] IS NOT NULL")).agg(F.collect_list(F.struct("chars", "words")).alias("_references"))
    # A text of another language is compared with its own too. These are few beside the texts of all.
    other = F.col("lang").isNotNull() & ~F.col("lang").isin(*majors) & ~failed & (enough["char"] | enough["word"])
    own = known_languages.where("lang IS NOT NULL").select("lang", F.struct("chars", "words").alias("_own"))
    other = F.coalesce(other, F.lit(False))
    beside = features.where(other).join(own, "lang", "left")
    rows = features.where(~other).withColumn("_own", F.lit(None).cast(own.schema["_own"].dataType)).unionByName(beside)

    def compare(kind: str, of_text) -> Column:
        every = F.expr(f"array_min(transform(_references, r -> {of_text('r')}))")
        return F.when(~failed & enough[kind], F.least(every, F.when(F.col("_own").isNotNull(), F.expr(of_text("_own")))))

    distances = rows.withColumn("_references", nearest.scalar()).withColumns(
        {
            "char_distance": compare("char", lambda r: distance("_classes", "_chars", f"{r}.chars")),
            "word_distance": compare("word", lambda r: word_distance("_counts", "_common", f"{r}.words")),
        }
    )
    near = F.expr(
        f"""coalesce(char_distance <= {MAX_CHAR_DISTANCE}, true)
            AND coalesce(word_distance <= {MAX_WORD_DISTANCE}, true)"""
    )
    return distances.withColumn("base_failed", failed).select(
        "_row", "n_words", *COUNTS, "base_failed", "char_distance", "word_distance",
        (~F.col("base_failed") & near).alias("kept"),
    )


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``(doc_id, n_words, base counts, base_failed, char_distance, word_distance, kept)`` of every row."""
    judged = _judged(docs, [F.col(doc_id).alias("doc_id")], text, lang)
    return judged.select(F.col("_row.doc_id").alias("doc_id"), *(c for c in judged.columns if c != "_row"))


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    judged = _judged(docs, [F.col(quoted(c)) for c in docs.columns], text, lang)
    return judged.where("kept").select(*(F.col(f"_row.{quoted(c)}").alias(c) for c in docs.columns))
