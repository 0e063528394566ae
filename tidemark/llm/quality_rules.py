"""Quality rules: base counts, and how far a text's histograms lie from its language's.

Two histograms per document, of character classes and of common words, are compared with
references by the Jensen-Shannon distance (base 2, 0 to 1). The references are sums over
all documents of a language. Everything is DataFrame functions: arrays are walked once,
inside the row, and only the references are aggregated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import stored

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "a al an and are as au aux avec be by con da das de del dem den der des die du e ein eine el en es et for "
    "from für in is ist it la las le les los mit nicht no of on or par pas para por pour que qui se sich su sur "
    "that the this to un una und une von was with y zu"
).split()
# Character classes, taken off the text one after the other; the rest is the last class.
CLASSES = {
    "lower": "[a-z]+",
    "space": r"[\x20\x09-\x0D]+",
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "stop": r"""[.,;:!?'"()\-]+""",
    "sign": r"[#*$%&|<>]+",
    "other_ascii": r"[\x00-\x7F]+",
}
_SPACES = r"[\x20\x09-\x0D]+"
_FIRST_CODE = 0x4E00
#: Not in the histogram: numbers and keys within a good text say nothing of its language.
_IDENTIFIERS = ("digit", "other_ascii")
#: Cells of the two histograms.
_CELLS = {"classes": len(CLASSES) + 1 - len(_IDENTIFIERS), "common": len(COMMON_WORDS) + 1}


def _code(i: int) -> str:
    return chr(_FIRST_CODE + i)


def _shifted(array: Column, by: int) -> Column:
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def _covered(windows: Column, width: int) -> Column:
    """How many positions the windows found twice or more cover; one hash per window."""

    def positions(ranked: Column) -> Column:
        following = F.zip_with(ranked, _shifted(ranked, 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        preceding = F.concat(F.array(F.lit(False)), following)
        marked = F.zip_with(
            ranked,
            F.zip_with(following, F.slice(preceding, 1, F.size(ranked)), lambda a, b: a | b),
            lambda a, twice: F.when(twice, a["i"]),
        )
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def reach(at: Column) -> Column:
        gaps = F.zip_with(at, _shifted(at, 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda sum_, gap: sum_ + gap)

    ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # a one-element array binds a value, so that it is computed once
    bound = F.transform(F.transform(F.array(ranked), positions), reach)[0]
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(bound)


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, the base counts and both histograms of each row."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select("doc_id", "lang", text.alias("text"))
    df = df.withColumn("words", F.array_remove(F.split("text", _SPACES), ""))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    pairs = F.zip_with("words", _shifted(F.col("words"), 1), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, _shifted(F.col("words"), 2), lambda pair, word: F.xxhash64(pair, word))
    df = df.withColumn("windows", F.slice(windows, 1, F.greatest(F.size("words") - 2, F.lit(0))))

    codes = F.create_map(
        *(F.lit(x) for i, w in enumerate(COMMON_WORDS) for x in (w, _code(i)) ),
        *(F.lit(x) for i, w in enumerate(COMMON_WORDS) for x in (w.capitalize(), _code(i))),
    )
    spelled = [*COMMON_WORDS, *(w.capitalize() for w in COMMON_WORDS)]
    common = F.filter("words", lambda word: word.isin(spelled))
    df = df.withColumn("codes", F.array_join(F.transform(common, lambda word: codes[word]), ""))

    df = df.withColumn("left0", F.col("text"))
    for i, pattern in enumerate(CLASSES.values()):
        df = df.withColumn(f"left{i + 1}", F.regexp_replace(f"left{i}", pattern, ""))
    classes = [
        (F.char_length(f"left{i}") - F.char_length(f"left{i + 1}")).cast("long") for i in range(len(CLASSES))
    ] + [F.char_length(f"left{len(CLASSES)}").cast("long")]
    found = [(F.char_length("codes") - F.char_length(F.replace("codes", F.lit(_code(i))))).cast("long")
             for i in range(len(COMMON_WORDS))]
    n_words = F.size("words").cast("long")
    return df.select(
        "doc_id",
        "lang",
        n_words.alias("n_words"),
        (F.char_length("text") - classes[1]).cast("long").alias("word_chars"),
        classes[list(CLASSES).index("sign")].alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("windows"), 3).alias("n_repeat_words"),
        F.array(*(classes[i] for i, name in enumerate([*CLASSES, "letter"]) if name not in _IDENTIFIERS)).alias("classes"),
        F.array(*found, n_words - F.char_length("codes")).alias("common"),
    )


def _shares(counts: Column) -> Column:
    """Each cell's part of the sum, NULL where that is 0."""
    total = F.aggregate(counts, F.lit(0.0), lambda sum_, n: sum_ + n)
    # a one-element array binds the sum: inside the inner function it would be made anew for every cell
    return F.transform(F.array(F.nullif(total, F.lit(0.0))), lambda all_: F.transform(counts, lambda n: n / all_))[0]


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts from the shares of another; 0 if one is empty."""

    def term(x: Column, mean: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mean)).otherwise(0.0)

    terms = F.zip_with(
        _shares(counts), reference, lambda p, q: (term(p, (p + q) / 2) + term(q, (p + q) / 2)) / 2
    )
    divergence = F.aggregate(terms, F.lit(0.0), lambda sum_, x: sum_ + x)
    return F.coalesce(F.sqrt(F.greatest(divergence, F.lit(0.0))), F.lit(0.0))


def _shares_of(counts: list[int]) -> Column:
    """:func:`_shares` of known numbers."""
    total = float(sum(counts))
    return F.array(*(F.lit(n / total if total else None).cast("double") for n in counts))


def _with_distances(counted: DataFrame, typical: Column, least_words: int) -> DataFrame:
    """Add both distances from the references: sums over the ``typical`` documents of a
    language, or of all languages where these have fewer than ``least_words`` words."""
    sums = {
        name: F.array(*(F.coalesce(F.sum(F.col(name)[i]), F.lit(0)) for i in range(n))) for name, n in _CELLS.items()
    }
    typical_rows = counted.where(typical)
    # one number per cell of the histograms
    total = typical_rows.agg(*(x.alias(name) for name, x in sums.items())).first()
    references = (
        typical_rows.where("lang IS NOT NULL")
        .groupBy("lang")
        .agg(*(x.alias(f"all_{name}") for name, x in sums.items()), F.sum("n_words").alias("all_words"))
        .where(F.col("all_words") >= least_words)
        .select("lang", *(_shares(F.col(f"all_{name}")).alias(f"all_{name}") for name in sums))
    )
    every = {name: _shares_of(total[name]) for name in sums}
    return counted.join(references, "lang", "left").select(
        *(F.col(c) for c in counted.columns),
        *(
            _distance(F.col(part), F.coalesce(f"all_{part}", every[part])).alias(name)
            for part, name in (("classes", "class_distance"), ("common", "word_distance"))
        ),
    )


def quality_rules(
    docs: DataFrame,
    least_words: int = 50,
    repeat_percent: int = 50,
    most_class_distance: float = 0.18,
    most_word_distance: float = 0.5,
    least_common: int = 100,
    least_reference: int = 1000,
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept``, one row per row of ``docs``.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``. ``base_failed``: fewer than
    ``least_words`` words, or more than ``repeat_percent`` % of them in repeated 3-word
    windows. Other documents are kept unless their character classes lie over
    ``most_class_distance`` from those of their language, or, with at least
    ``least_common`` words, their common words over ``most_word_distance``.

    The references are sums over all documents that pass the base counts, and then over
    those of them that lie near these first sums, so that much junk doesn't move them.
    Languages with fewer than ``least_reference`` words there, and null, are measured
    against all languages. Null and empty texts have no words and fail.
    """
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    far = (F.col("class_distance") > most_class_distance) | (
        (F.col("n_words") >= least_common) & (F.col("word_distance") > most_word_distance)
    )
    counted = stored(base_counts(docs).withColumn("base_failed", failed), "counts")
    first = _with_distances(counted, ~F.col("base_failed"), least_reference)
    near = stored(
        first.withColumn("near", ~F.col("base_failed") & ~far).drop("class_distance", "word_distance"), "near"
    )
    measured = _with_distances(near, F.col("near"), least_reference).drop("lang", "near", *_CELLS)
    return measured.withColumn("kept", ~F.col("base_failed") & ~far)
