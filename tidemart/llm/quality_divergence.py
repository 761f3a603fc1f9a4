"""Quality rules by distribution divergence (op 7), DataFrame functions only.

Every document gets two histograms, over character classes and over the common
words of its language, and each is compared with the language's reference by
Jensen-Shannon distance (base 2, 0 to 1). References are the summed histograms
of all documents of that language that pass the base rules, plus a fixed number
of words and characters dealt out as in all languages together; these weigh
nothing in a large language and stand in for the missing text in a rare one, so
documents are judged alike at every size. A document is rejected when a distance
exceeds its bound, if it has enough words to be judged.
The word bound is a share of the distance that a text without any common word
has from the same reference, so such a text is always beyond it.

Per document everything is computed inside its row (no shuffle); only one small
profile row per document is written and summed per language.

Defined results: NULL and empty texts have no words and fail the base rules;
a NULL or unlisted language has no common-word list, so only the character
classes are compared (with the reference of that language value, NULL being a
value); repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_and_reread

SPACE = r"\x20\x09-\x0D"

# fixed values: the commonest function words of each language, lower case
COMMON_WORDS = {
    "en": "the of and to in a is that it was for on with as be at by this are or an from have "
          "not".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se "
          "avec".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
          "es an werden".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más "
          "o".split(),
}

MIN_WORDS = 50          # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50  # base rule: more than this share of words in repeated windows fails
GUARD_WORDS = 100       # the method judges no shorter text
PRIOR_WORDS = 10_000     # added to each reference, as in all languages together
PRIOR_CHARS = 50_000     # its letters are of the language's own kinds, so no script is odd for being rare
MAX_CLASS_DISTANCE = 0.35
MAX_WORD_SHARE = 0.8    # of the distance of a text without common words
# fixed values: the character classes, taken off one after the other (what is left is "other")
CLASSES = [("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"),
           ("symbol", r"[#*$%&|<>]+"), ("letter", r"\p{L}+"), ("punct", "[!-~]+")]
LETTER_BINS = [i for i, (name, _) in enumerate(CLASSES) if name in ("lower", "upper", "letter")]


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row: a lambda variable
    is bound to it, so inner lambdas do not evaluate it again per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_positions(w: Column) -> Column:
    """Start positions (ascending) of 3-word windows found twice or more in ``w``."""
    hashes = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))

    def twice(h: Column) -> Column:  # the values found twice or more
        return _let(F.sort_array(h), lambda s: F.array_distinct(F.filter(
            s, lambda x, j: (j > 0) & (x == F.get(s, j - 1)))))

    def few(h: Column, d: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(h) - 1),
                        lambda i: F.array_contains(d, F.get(h, i)))

    def many(h: Column) -> Column:  # sorted by (hash, place): neighbours share the hash
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(placed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])),
            lambda x: x["i"])))

    none = F.array().cast("array<int>")
    return _let(hashes, lambda h: _let(twice(h), lambda d: F.when(F.size(d) == 0, none)
                                       .when(F.size(d) <= 32, few(h, d)).otherwise(many(h))))


def _covered(positions: Column) -> Column:
    """Words covered by 3-word windows at ``positions`` (ascending)."""
    return _let(positions, lambda p: F.aggregate(
        F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(3)), F.lit(3))),
        F.lit(0).cast("bigint"), lambda a, x: a + x))


def _common_counts(words: Column, lang: Column) -> Column:
    """Counts of the language's common words, in the order of its list; NULL
    without a list."""
    out = F.lit(None).cast("array<bigint>")
    for code, listed in COMMON_WORDS.items():
        lst = F.array(*[F.lit(x) for x in listed])
        # only listed words are kept, each between two marks; a count is then
        # what taking the marked word away shortens
        kept = F.transform(F.filter(words, lambda w: F.array_contains(lst, F.lower(w))), F.lower)
        marked = F.concat(F.lit("\x01"), F.array_join(kept, "\x02\x01"), F.lit("\x02"))

        def count(text: Column, x: str) -> Column:
            gone = F.replace(text, F.lit(f"\x01{x}\x02"), F.lit(""))
            size = len(x.encode()) + 2
            return F.floor((F.octet_length(text) - F.octet_length(gone)) / size).cast("bigint")

        out = F.when(lang == code, _let(marked, lambda m: F.array(*[count(m, x) for x in listed]))
                     ).otherwise(out)
    return out


def with_profile(docs: DataFrame, *, text: str = "text", lang: str = "lang",
                 min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``row`` (the document's columns as they came) and ``profile``: counts,
    base verdict and the two histograms."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(F.col("_body"), "\n"), lambda x: F.regexp_like(x, F.lit(f"[^{SPACE}]")))
    df = docs.select(F.struct("*").alias("row"), F.col(lang).alias("_lang"), body.alias("_body"))
    df = df.withColumn("_w", F.filter(F.split("_body", f"[{SPACE}]+"), lambda w: w != ""))
    df = df.withColumns({
        "_n": F.size("_w").cast("bigint"), "_t": F.array_join("_w", ""),
        "_dup": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "_rep": _let(F.col("_w"), lambda w: _covered(_repeat_positions(w))),
        "_common": _common_counts(F.col("_w"), F.col("_lang"))}).drop("_w", "_body")
    df = df.withColumn("_chars", F.length("_t").cast("bigint"))
    for name, pattern in CLASSES:
        df = df.withColumn("_rest", F.regexp_replace("_t", pattern, ""))
        df = df.withColumn(f"_c_{name}", (F.length("_t") - F.length("_rest")).cast("bigint"))
        df = df.withColumn("_t", F.col("_rest")).drop("_rest")
    classes = F.array(*[F.col(f"_c_{n}") for n, _ in CLASSES], F.length("_t").cast("bigint"))
    failed = (F.col("_n") < min_words) | (100 * F.col("_rep") > max_repeat_percent * F.col("_n"))
    return df.select("row", F.struct(
        F.col("_lang").alias("lang"), F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"), F.col("_c_symbol").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"), F.col("_rep").alias("n_repeat_words"),
        failed.alias("base_failed"), classes.alias("classes"),
        F.col("_common").alias("common")).alias("profile"))


def _with_rest(counts: Column, total: Column) -> Column:
    """Counts with what is left of ``total`` as the last bin."""
    listed = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.concat(counts, F.array(total - listed))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root of the divergence, base 2) of two
    histograms given as arrays of counts or weights; NULL where either is empty."""
    def share(a: Column) -> Column:
        a = a.cast("array<double>")  # counts below 2^53 stay exact
        return _let(F.aggregate(a, F.lit(0.0), lambda s, x: s + x),
                    lambda n: F.when(n > 0, F.transform(a, lambda x: x / n)))

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    parts = F.zip_with(share(p), share(q),
                       lambda x, y: part(x, (x + y) / 2) / 2 + part(y, (x + y) / 2) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return _let(total, lambda t: F.when(t < 0, F.lit(0.0)).otherwise(F.sqrt(t)))


def language_references(profiled: DataFrame, *, prior_words: int = PRIOR_WORDS,
                        prior_chars: int = PRIOR_CHARS) -> DataFrame:
    """``lang, ref_classes, ref_common, no_common_distance``: histograms summed
    over all documents that pass the base rules, with the prior (``ref_common``
    with its rest bin), and how far a text without any common word is from the
    latter."""
    good = profiled.select("profile.*").filter("not base_failed")
    n_bins = max(map(len, COMMON_WORDS.values()))
    zero = F.lit(0).cast("bigint")
    common = [F.coalesce(F.sum(F.get("common", F.lit(i))), zero) for i in range(n_bins)]
    classes = [F.sum(F.get("classes", F.lit(i))) for i in range(len(CLASSES) + 1)]
    own = write_and_reread(good.groupBy("lang").agg(  # one row a language
        F.array(*classes).alias("classes"), F.array(*common).alias("common"), F.sum("n_words").alias("words")),
        "language-sums")
    listed = F.col("lang").isin(*COMMON_WORDS)
    total = own.agg(  # one row
        *[F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES) + 1)],
        F.sum(F.when(listed, F.aggregate("common", zero, lambda s, x: s + x))).alias("common"),
        F.sum(F.when(listed, F.col("words"))).alias("words")).first()
    chars = [total[f"c{i}"] or 0 for i in range(len(CLASSES) + 1)]
    class_prior = [prior_chars * c / sum(chars) if sum(chars) else 0.0 for c in chars]
    letter_prior = sum(class_prior[i] for i in LETTER_BINS)
    letters = sum(F.get("classes", F.lit(i)) for i in LETTER_BINS)
    common_share = (total["common"] or 0) / total["words"] if total["words"] else 0.0
    sizes = F.coalesce(F.create_map(*[F.lit(x) for code, ws in COMMON_WORDS.items() for x in (code, len(ws))])[F.col("lang")],
                       F.lit(n_bins))

    def with_prior(counts: Column) -> Column:
        return F.transform(counts, lambda x, i: x + F.when(
            i < sizes, F.lit(prior_words * common_share) / sizes).otherwise(0.0))

    rest = F.col("words") - F.aggregate("common", zero, lambda s, x: s + x) + F.lit(prior_words * (1 - common_share))
    mixed = [F.get("classes", F.lit(i)) + (
        F.when(letters > 0, F.lit(letter_prior) * F.get("classes", F.lit(i)) / letters).otherwise(F.lit(x))
        if i in LETTER_BINS else F.lit(x)) for i, x in enumerate(class_prior)]
    ref = own.select("lang", F.array(*mixed).alias("ref_classes"),
                     F.concat(with_prior(F.col("common")), F.array(rest)).alias("ref_common"))
    none = F.concat(F.array_repeat(F.lit(0.0), n_bins), F.array(F.lit(1.0)))
    return ref.withColumn("no_common_distance", js_distance(none, F.col("ref_common")))


def judge(profiled: DataFrame, references: DataFrame, *, guard_words: int = GUARD_WORDS,
          max_class_distance: float = MAX_CLASS_DISTANCE, max_word_share: float = MAX_WORD_SHARE) -> DataFrame:
    """``row``, ``profile``, the two distances and ``kept``."""
    ref = references.withColumnRenamed("lang", "_ref_lang")
    j = profiled.join(ref, F.col("profile.lang").eqNullSafe(F.col("_ref_lang")), "left")
    by_class = js_distance(F.col("profile.classes"), F.col("ref_classes"))
    by_word = F.when(F.col("profile.common").isNotNull(), js_distance(
        _with_rest(F.col("profile.common"), F.col("profile.n_words")), F.col("ref_common")))
    j = j.select("row", "profile", by_class.alias("class_distance"), by_word.alias("word_distance"),
                 (F.col("no_common_distance") * max_word_share).alias("_word_bound"))
    far = (F.coalesce(F.col("class_distance") > max_class_distance, F.lit(False))
           | F.coalesce(F.col("word_distance") > F.col("_word_bound"), F.lit(False)))
    judged = F.col("profile.n_words") >= guard_words
    return j.withColumn("kept", ~F.col("profile.base_failed") & ~(judged & far)).drop("_word_bound")


#: References are broadcast up to this many languages (about 1 KB each).
MAX_BROADCAST_LANGUAGES = 10_000


def quality_verdicts(docs: DataFrame, *, text: str = "text", lang: str = "lang",
                     keep: list[str] | None = None, **bounds) -> DataFrame:
    """``row`` (of the columns ``keep``, default all), ``profile``, distances
    and ``kept`` for every row of ``docs``."""
    profiled = with_profile(docs, text=text, lang=lang)
    if keep is not None:
        profiled = profiled.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in keep]))
    profiled = write_and_reread(profiled, "profiles")
    refs = write_and_reread(language_references(profiled), "references")
    if refs.count() <= MAX_BROADCAST_LANGUAGES:
        refs = F.broadcast(refs)
    return judge(profiled, refs, **bounds)
