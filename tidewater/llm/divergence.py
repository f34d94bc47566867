"""Distribution divergence: quality rules from character-class and common-word histograms.

Each document gets a histogram over character classes and one over the commonest words of the reference languages. The
references are the pooled histograms of the documents of each language in the corpus itself. A document is compared with
every reference by Jensen-Shannon distance; the closest one counts. Only DataFrame functions run; a first pass gathers one row
per reference language, a second one maps over the documents without any shuffle.

Defined cases: a null text is an empty one; an empty text has no words and fails the base rule; a document whose language is null
or unknown is still compared with all references; with no reference at all (an empty table, no document of a known language)
the method rejects nothing; repeated rows are judged one by one; columns of any other name pass through ``judge`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, words

# Very common words of four languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una"],
}
#: Java patterns of character classes among the characters of words; lower-case a-z come first, all others last.
CLASSES = ["[A-Z]+", "[#*$%&|<>]+", "[0-9]+", "[\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]+", "[\\u00C0-\\u024F]+"]
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.22
MAX_WORD_DISTANCE = 0.4
#: Documents with a larger share of capitals and symbols stay out of the references.
MAX_ODD_SHARE = 0.1
#: Below this number of words the common-word histogram is too thin to judge by.
MIN_WORDS_FOR_COMMON = 100


def _vocabulary() -> list[str]:
    return list(dict.fromkeys(w for ws in COMMON_WORDS.values() for w in ws))


def _stages(df: DataFrame, text: str, keep: list[str], names: dict[str, str]) -> DataFrame:
    """df with word array, characters in words, symbols, class counts and common-word counts."""
    n = names
    vocabulary = _vocabulary()
    df = df.withColumn(n["w"], words(F.col(text)))
    df = df.withColumn(n["solid"], F.array_join(F.col(n["w"]), ""))
    df = df.withColumn(n["rest"], F.regexp_replace(n["solid"], "[a-z]+", ""))
    common = F.filter(F.col(n["w"]), lambda x: x.isin(vocabulary))
    # One character for each common word: counting them is then short work.
    alphabet = "".join(map(chr, range(48, 48 + len(vocabulary))))
    coded = F.transform(common, lambda x: F.substring(F.lit(alphabet), F.array_position(F.array(*map(F.lit, vocabulary)), x).cast("int"), F.lit(1)))
    df = df.withColumn(n["said"], F.array_join(coded, ""))
    left, counts = F.col(n["rest"]), [F.length(n["solid"]) - F.length(n["rest"])]
    for pattern in CLASSES:
        # The symbols come before the other punctuation, which holds them too.
        less = F.regexp_replace(left, pattern, "")
        counts.append(F.length(left) - F.length(less))
        left = less
    counts.append(F.length(left))
    said = F.col(n["said"])
    slots = F.array(*[(F.length(said) - F.length(F.replace(said, F.lit(c), F.lit("")))).cast("double") for c in alphabet])
    return df.select(
        *keep,
        F.length(n["solid"]).cast("long").alias(n["chars"]),
        F.col(n["w"]),
        F.array(*[c.cast("double") for c in counts]).alias(n["classes"]),
        slots.alias(n["slots"]),
    )


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, tuple[list[float], list[float]]]:
    """Language to (class histogram, common-word histogram), pooled over all its documents; at most one row per language of COMMON_WORDS."""
    names = {k: k for k in ("w", "solid", "rest", "said", "chars", "classes", "slots")}
    known = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where(F.col("l").isin(list(COMMON_WORDS)))
    found = _stages(known, "t", ["l"], names)
    # Documents of capitals or symbols are no models of a language. Not a filter: pushed down, it would compute all counts twice.
    model = (F.size("w") >= MIN_WORDS) & (F.col("classes")[1] + F.col("classes")[2] <= MAX_ODD_SHARE * F.col("chars"))
    k, v = len(CLASSES) + 2, len(_vocabulary())
    counts = found.select("l", F.posexplode(F.when(model, F.concat("classes", "slots", F.array(F.size("w").cast("double"))))).alias("at", "n"))
    sums = {(r["l"], r["at"]): r["n"] for r in counts.groupBy("l", "at").agg(F.sum("n").alias("n")).collect()}
    out = {}
    for code in {c for c, _ in sums}:
        classes, slots = ([sums[code, i] for i in span] for span in (range(k), range(k, k + v)))
        slots.append(sums[code, k + v] - sum(slots))
        out[code] = tuple([x / max(sum(h), 1.0) for x in h] for h in (classes, slots))
    return dict(sorted(out.items()))


def _distance(p: Column, total: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) between counts p of the given total and the histogram q."""
    def h(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x)).otherwise(0.0)

    # sum p log p + q log q - (p + q) log((p + q) / 2), halved; the part of q alone is a constant.
    terms = F.zip_with(p, F.array(*[F.lit(float(x)) for x in q]), lambda a, b: h(a / total) - (a / total + b) * F.log2(F.greatest((a / total + b) / 2, F.lit(1e-300))))
    own = sum(x * math.log2(x) for x in q if x > 0)
    divergence = (F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x) + F.lit(own)) / 2
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _covered(at: Column) -> Column:
    """Size of the union of [p, p + 3) over the sorted positions."""
    return F.aggregate(F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(3)), F.lit(3)).cast("long")), F.lit(0).cast("long"), lambda acc, x: acc + x)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> tuple[DataFrame, str]:
    """docs with a struct column of all counts, distances and verdicts; the name of that column."""
    refs = references(docs, text, lang)
    own = docs.columns
    names = {k: fresh(docs, f"_dd_{k}") for k in ("w", "solid", "rest", "said", "chars", "classes", "slots", "hash", "at", "lines", "v", "m", "count")}
    n = {k: F.col(v) for k, v in names.items()}
    keep = [F.col(f"`{c}`") for c in own]
    df = _stages(docs, text, keep, names)
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w = n["w"]
    hashes = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.greatest(F.size(w) - 2, F.lit(0)))
    df = df.select(*keep, n["chars"], n["classes"], n["slots"], F.size(w).cast("long").alias(names["count"]), hashes.alias(names["hash"]), lines.alias(names["lines"]))
    again = F.size(n["hash"]) > F.size(F.array_distinct(n["hash"]))
    # Windows in the order of their hashes; those that a neighbour has too, in the order of their places.
    pairs = F.sort_array(F.transform(n["hash"], lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("p"))))
    df = df.withColumn(names["m"], F.when(again, pairs))
    m = n["m"]
    same = lambda x, i: F.coalesce(x["h"] == F.get(m, i)["h"], F.lit(False))
    at = F.sort_array(F.transform(F.filter(m, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"]))
    df = df.withColumn(names["at"], F.coalesce(at, F.array().cast("array<bigint>")))
    char_total = F.greatest(n["chars"].cast("double"), F.lit(1.0))
    word_total = F.greatest(n["count"].cast("double"), F.lit(1.0))
    slots = F.concat(n["slots"], F.array(n["count"].cast("double") - F.aggregate(n["slots"], F.lit(0.0), lambda acc, x: acc + x)))
    by_char = {k: _distance(n["classes"], char_total, v[0]) for k, v in refs.items()}
    by_word = {k: _distance(slots, word_total, v[1]) for k, v in refs.items()}
    both = F.array(*[F.struct((by_char[k] + by_word[k]).alias("sum"), by_char[k].alias("chars"), by_word[k].alias("words"), F.lit(k).alias("ref")) for k in refs])
    df = df.withColumn(names["v"], F.array_min(both) if refs else F.lit(None).cast("struct<sum:double,chars:double,words:double,ref:string>"))
    repeated = _covered(n["at"])
    base = F.struct(
        n["count"].alias("n_words"),
        n["chars"].alias("word_chars"),
        n["classes"][2].cast("long").alias("n_symbols"),
        (F.size(n["lines"]) - F.size(F.array_distinct(n["lines"]))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        n["v"]["chars"].alias("char_distance"),
        n["v"]["words"].alias("word_distance"),
        n["v"]["ref"].alias("closest"),
    )
    df = df.select(*keep, base.alias(names["v"]))
    v = n["v"]
    failed = (v["n_words"] < MIN_WORDS) | (100 * v["n_repeat_words"] > 50 * v["n_words"])
    far = F.coalesce((v["char_distance"] > max_char) | ((v["n_words"] >= MIN_WORDS_FOR_COMMON) & (v["word_distance"] > max_word)), F.lit(False))
    # A filter on a verdict would be pushed down through all projections and compute every count anew, within each lambda. It is not
    # pushed past an expression that counts as non-deterministic, though this one is always true.
    here = F.monotonically_increasing_id() >= 0
    return df.withColumn(names["v"], v.withField("base_failed", failed).withField("kept", ~failed & ~far & here)), names["v"]


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, the distances to the closest reference and the verdicts."""
    df, v = judge(docs)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance", "closest"]
    return df.select("doc_id", *[F.col(v)[c].alias(c) for c in cols])


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    df, v = judge(docs)
    return df.where(F.col(v)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
