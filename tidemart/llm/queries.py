"""The registered queries of the training-data operators, with their SQL.

Each query applies its operator with production parameters to its whole table
and derives the digest columns from the operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_words, chat_trees, collocations, decontaminate, importance, language_crf, line_dedup,
               quality_divergence, sharding, shared_files, simhash, token_pack, url_bloom, warc)
from .bpe import default_tokenizer_path
from .common import table

URL_RULES = [url_bloom.Rule("block", "net", "/"), url_bloom.Rule("allow", "example.net", "/en/"),
             url_bloom.Rule("block", "example.com", "/de/"), url_bloom.Rule("allow", "org", "/fr/")]
#: The list of op9: canonical URLs that the crawl fetched at least this often.
LISTED_FROM_FETCHES = 2
PROBE_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"))
    template = chat_trees.Template()
    done = chat_trees.format_conversations(
        chat_trees.threads_from_turns(said.unionByName(probe)), template=template)
    read = done.withColumns({
        "turns": template.parse(F.col("formatted")),
        "loss": chat_trees.masked_text(F.col("formatted"), F.col("loss_spans"), template)})
    spoken = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


_ESCAPED = r"regexp_replace({0}, '([\[<])(\\*)(INST\]|/INST\]|/s>)', '\1\\\2\3', 'g')"

OP1_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE_TEXT}'),
folded AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS spoken,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('[INST][/INST]</s>') + length({_ESCAPED.format('role')})
        + length({_ESCAPED.format('text')})) AS formatted_chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM folded"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.line_dedup(docs, min_docs=10, min_key_chars=1)
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_STRIP = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP2_SQL = f"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut),
keyed AS (
  SELECT doc_id, pos, line, {_LOWER.format(_STRIP.format('line'))} AS k FROM lines),
frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE k IN (SELECT k FROM frequent)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
         FILTER (WHERE k NOT IN (SELECT k FROM frequent)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id"""


def op3_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_tokenizer_path()
    back = bpe_words.encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"],
                            piece_rows=bpe_words.piece_table(spark, path))
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.with_revisits(table(spark, sf_dir, "pages"))
    manifest = warc.write_warc(records, shared_files.new_folder(spark, "warc"))
    read = warc.read_warc(manifest, payloads=False)
    return warc.whole_records_of(read).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
k AS (SELECT html, max(page_id) AS keeper FROM p WHERE size >= 1000 GROUP BY html)
SELECT page_id, size AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.html = k.html"""


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, edits, from_word, to_word: benchmark passages in documents."""
    return decontaminate.contaminated_passages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_pack.write_token_files(
        table(spark, sf_dir, "documents"), default_tokenizer_path(), shared_files.new_folder(spark, "tokens"))
    return token_pack.read_token_files(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    v = quality_divergence.quality_verdicts(docs, keep=["doc_id"])
    return v.select("row.doc_id", "profile.n_words", "profile.word_chars", "profile.n_symbols",
                    "profile.n_dup_lines", "profile.n_repeat_words", "profile.base_failed", "kept")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def fetched_often(pages: DataFrame, at_least: int = LISTED_FROM_FETCHES) -> DataFrame:
    """``canonical``: canonical URLs that at least ``at_least`` rows of ``pages`` share."""
    seen = pages.select(url_bloom.canonical_url(F.col("url")).alias("c")).filter("c is not null")
    often = seen.groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= at_least)
    return often.select(F.col("c").alias("canonical"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    v = url_bloom.url_verdicts(pages, fetched_often(pages), URL_RULES, listed_canonical="canonical")
    return v.select("page_id", "host", "path", "rule", "verdict")


def _rule_case(column: str) -> str:
    arms = "".join(
        f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        f" THEN '{getattr(r, column)}'"
        for r in sorted(URL_RULES, key=lambda r: -len(r.name)))
    return f"CASE{arms} END"


OP9_SQL = f"""
WITH cut AS (
  SELECT page_id, contains(url, '://') AS whole, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, whole, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS host,
    regexp_extract(coalesce(rest, ''), '^[^?#]*') AS host_path,
    regexp_extract(coalesce(rest, ''), '^[^?#]*\\?([^#]*)', 1) AS query FROM cut),
named AS (
  SELECT page_id, whole, {_LOWER.format("host")} AS host, substr(host_path, length(host) + 1) AS path,
    list_filter(regexp_split_to_array(query, '[?&]'), lambda x: x <> ''
      AND NOT regexp_full_match(x, '(utm_[^&=]*|ref)(=[^&]*)?')) AS kept FROM split),
canonical AS (
  SELECT *, CASE WHEN whole THEN host || regexp_replace(path, '/+$', '')
    || CASE WHEN len(kept) > 0 THEN '&' || array_to_string(kept, '&') ELSE '' END END AS canon FROM named),
counted AS (SELECT *, count(canon) OVER (PARTITION BY canon) AS n FROM canonical)
SELECT page_id, host, path, {_rule_case('name')} AS rule,
  coalesce({_rule_case('action')}, CASE WHEN n >= {LISTED_FROM_FETCHES} THEN 'block' ELSE 'allow' END) AS verdict
FROM counted"""


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH cut AS (
  SELECT coalesce(lang, '{collocations.UNKNOWN_LANG}') AS lang,
    unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM cut),
words AS (SELECT lang, x AS part, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM pieces) GROUP BY ALL),
pairs AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f
  FROM (SELECT lang, w, unnest(generate_series(1, len(w) - 1)) AS i FROM pieces) GROUP BY ALL
  HAVING count(*) >= {collocations.MIN_COUNT}),
triples AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f
  FROM (SELECT lang, w, unnest(generate_series(1, len(w) - 2)) AS i FROM pieces) GROUP BY ALL
  HAVING count(*) >= {collocations.MIN_COUNT}),
parts AS (SELECT * FROM words UNION ALL SELECT lang, w1 || ' ' || w2, f FROM pairs),
inside AS (
  SELECT lang, a, b, max(f) AS most FROM (
    SELECT lang, w1 AS a, w2 AS b, f FROM triples UNION ALL SELECT lang, w2, w3, f FROM triples) GROUP BY ALL),
cuts AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, f AS a, 1 AS k, w1 AS head, w2 AS tail
  FROM pairs LEFT JOIN (SELECT lang, a AS w1, b AS w2, most FROM inside) USING (lang, w1, w2)
  WHERE most IS NULL OR 100 * most < {collocations.KEEP_INSIDE_PERCENT} * f
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, f, 1, w1, w2 || ' ' || w3 FROM triples
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, f, 2, w1 || ' ' || w2, w3 FROM triples),
scored AS (
  SELECT c.lang, phrase, a, k, h.f AS l, t.f AS r,
    CAST((1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN parts h ON h.lang = c.lang AND h.part = head JOIN parts t ON t.lang = c.lang AND t.part = tail),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM words GROUP BY lang) USING (lang)
WHERE rank <= {collocations.TOP}"""


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = importance.importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return done.select("row.doc_id", "n_features", "weight", "score", "rank")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = language_crf.identify(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return done.select("row.doc_id", language_crf.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def _op7_sql() -> str:
    q = quality_divergence
    space = r"[\x20\x09-\x0D]"
    listed = ", ".join(f"('{code}', {i}, '{w}')" for code, ws in q.COMMON_WORDS.items() for i, w in enumerate(ws))
    letter_bins = ", ".join(str(i + 1) for i in q.LETTER_BINS)
    classes, left = [], "t"
    for _, pattern in q.CLASSES:
        rest = f"regexp_replace({left}, '{pattern}', '', 'g')"
        classes.append(f"length({left}) - length({rest})")
        left = rest
    classes.append(f"length({left})")
    return f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS body FROM documents),
words AS (
  SELECT doc_id, lang, body, list_filter(regexp_split_to_array(body, '{space}+'), lambda x: x <> '') AS w FROM d),
grams AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM words)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM grams)
  WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (VALUES (0), (1), (2)) AS step(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM d),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
counts AS (
  SELECT words.doc_id, lang, w, array_to_string(w, '') AS t, len(w) AS n_words,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)),
based AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    [{', '.join(classes)}] AS classes FROM counts),
listed(lang, bin, word) AS (VALUES {listed}),
spoken AS (
  SELECT doc_id, lang, lower(x) AS word, count(*) AS n
  FROM (SELECT doc_id, lang, unnest(w) AS x FROM based) GROUP BY ALL),
class_bins AS (
  SELECT doc_id, lang, base_failed, unnest(classes) AS n, generate_subscripts(classes, 1) AS bin FROM based),
known_bins AS (
  SELECT doc_id, lang, base_failed, bin, coalesce(spoken.n, 0) AS n
  FROM based JOIN listed USING (lang) LEFT JOIN spoken USING (doc_id, lang, word)),
word_bins AS (
  SELECT * FROM known_bins UNION ALL
  SELECT doc_id, lang, based.base_failed, -1, any_value(n_words) - sum(n)
  FROM based JOIN known_bins USING (doc_id, lang) GROUP BY doc_id, lang, based.base_failed),
bins AS (
  SELECT 'class' AS kind, doc_id, lang, base_failed, bin, n FROM class_bins
  UNION ALL SELECT 'word', doc_id, lang, base_failed, bin, n FROM word_bins),
shares AS (
  SELECT *, n / nullif(sum(n) OVER (PARTITION BY kind, doc_id), 0) AS p FROM bins),
sums AS (SELECT kind, lang, bin, sum(n) AS n FROM bins WHERE NOT base_failed GROUP BY kind, lang, bin),
class_prior AS (SELECT bin, {q.PRIOR_CHARS} * sum(n) / nullif(sum(sum(n)) OVER (), 0) AS extra
  FROM sums WHERE kind = 'class' GROUP BY bin),
common_share AS (SELECT coalesce(sum(n) FILTER (WHERE bin >= 0) / nullif(sum(n), 0), 0) AS c FROM sums WHERE kind = 'word'),
list_sizes AS (SELECT lang, count(*) AS size FROM listed GROUP BY lang),
weights AS (
  SELECT kind, lang, bin, n + coalesce(CASE WHEN bin IN ({letter_bins}) AND letters > 0
    THEN (SELECT sum(extra) FROM class_prior WHERE bin IN ({letter_bins})) * n / letters ELSE extra END, 0) AS n
  FROM (SELECT *, sum(n) FILTER (WHERE bin IN ({letter_bins})) OVER (PARTITION BY lang) AS letters
        FROM sums WHERE kind = 'class') JOIN class_prior USING (bin)
  UNION ALL SELECT kind, lang, bin, n + {q.PRIOR_WORDS} * CASE WHEN bin >= 0 THEN c / size ELSE 1 - c END
  FROM sums JOIN list_sizes USING (lang), common_share WHERE kind = 'word'),
refs AS (
  SELECT kind, lang, bin, n / nullif(sum(n) OVER (PARTITION BY kind, lang), 0) AS q FROM weights),
word_bounds AS (
  SELECT lang, {q.MAX_WORD_SHARE} * sqrt(greatest(sum(
      CASE WHEN bin = -1 THEN log2(1 / ((1 + q) / 2)) / 2 ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((CASE WHEN bin = -1 THEN 1 ELSE 0 END + q) / 2)) / 2 ELSE 0 END), 0)) AS bound
  FROM refs WHERE kind = 'word' GROUP BY lang),
distances AS (
  SELECT shares.kind, doc_id, shares.lang, sqrt(greatest(sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) / 2 ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) / 2 ELSE 0 END), 0)) AS js
  FROM shares JOIN refs ON shares.kind = refs.kind AND shares.bin = refs.bin
    AND shares.lang IS NOT DISTINCT FROM refs.lang
  WHERE p IS NOT NULL AND q IS NOT NULL GROUP BY ALL),
far AS (
  SELECT doc_id, max(kind = 'class' AND js > {q.MAX_CLASS_DISTANCE}
                  OR kind = 'word' AND coalesce(js > bound, false)) AS is_far
  FROM distances LEFT JOIN word_bounds USING (lang) GROUP BY doc_id)
SELECT doc_id, n_words, length(t) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words >= {q.GUARD_WORDS} AND coalesce(is_far, false)) AS kept
FROM based LEFT JOIN far USING (doc_id)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    named = [op1_chat_formatting, op2_line_dedup, op3_bpe_words, op4_warc, op5_decontamination,
             op6_token_files, op7_quality_rules, op8_sharding, op9_url_filter, op10_simhash,
             op11_collocations, op12_resampling, op13_language_id]
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": OP1_SQL, "op2_line_dedup": OP2_SQL, "op4_warc": OP4_SQL,
            "op7_quality_rules": _op7_sql(), "op9_url_filter": OP9_SQL,
            "op11_collocations": OP11_SQL}
