"""The operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    feistel,
    html_extract,
    line_dedup,
    packing,
    quality_rules,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    toxicity,
)
from nestweave.llm.common import read

#: The key of the pseudonyms; a production run takes its own from its secret store.
KEY = "nestweave"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SEPARATOR = 49407


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel.pseudonymise(read(spark, sf_dir, "documents"), KEY)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), TOKENIZER)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.remove_repeated_runs(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.deduplicate(read(spark, sf_dir, "documents"), exact_dedup.DigestIndex.create(spark))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return rows.select("doc_id", "keep_id", "group_size", "kept", digest)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.count_tokens(read(spark, sf_dir, "documents"), TOKENIZER, SEPARATOR)
    return rows.select("doc_id", "n_tokens")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.select("doc_id", fingerprint, "component_id")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(*columns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_substring_dedup,
        op3_pii_pseudonyms,
        op4_best_fit_packing,
        op5_line_dedup,
        op6_exact_dedup,
        op7_benchmark_decontamination,
        op8_token_counts,
        op9_toxicity,
        op10_simhash_near_dedup,
        op11_phrase_collocations,
        op12_spelling_variants,
        op13_quality_rules,
    )
}

_LINES = r"""
rows AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS line, lines FROM rows),
runs AS (
    SELECT doc_id, line, width, lines[line:line + width - 1] AS run
    FROM places CROSS JOIN (VALUES (1), (2), (3)) AS w (width) WHERE line + width - 1 <= len(lines)
),
firsts AS (
    SELECT doc_id, line, width, row_number() OVER (
        PARTITION BY width, array_to_string(run, chr(10)) ORDER BY doc_id, line
    ) > 1 AS later
    FROM runs
    WHERE width = 3 OR len(list_filter(regexp_split_to_array(array_to_string(run, ' '), '[\x20\x09-\x0D]+'), lambda x: x <> '')) >= 50
),
gone AS (SELECT DISTINCT doc_id, unnest(range(line, line + width)) AS line FROM firsts WHERE later),
every AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS line, lines FROM rows)"""

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_DECONTAMINATION = f"""
doc_words AS (SELECT doc_id AS id, {_WORDS.format("lower(coalesce(text, ''))")} AS ws FROM documents),
item_words AS (SELECT item_id AS id, {_WORDS.format("lower(coalesce(text, ''))")} AS ws FROM benchmark),
in_docs AS (
    SELECT DISTINCT id, unnest(CASE WHEN len(ws) >= 5
        THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
    FROM doc_words
),
in_items AS (
    SELECT DISTINCT id, unnest(CASE WHEN len(ws) >= 5
        THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
    FROM item_words
),
sizes AS (SELECT id, count(*) AS n_shingles FROM in_items GROUP BY id)"""

_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(ws) - {k - 2}), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) AS phrase"
    f" FROM split WHERE len(ws) >= {k}"
    for k in range(1, 6)
)
_PHRASES = rf"""
lowered AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
split AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM ({_GRAMS}) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k >= 2 AND f >= 100),
cuts AS (
    SELECT lang, phrase, k, ws, a, unnest(range(1, k)) AS cut FROM candidates
),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, h.f AS l, t.f AS r, n.n,
        (1000::HUGEINT * c.a * n.n) // (h.f::HUGEINT * t.f) AS score
    FROM cuts c JOIN n ON n.lang = c.lang
    JOIN f h ON h.lang = c.lang AND h.k = c.cut AND h.phrase = array_to_string(c.ws[1:c.cut], ' ')
    JOIN f t ON t.lang = c.lang AND t.k = c.k - c.cut AND t.phrase = array_to_string(c.ws[c.cut + 1:], ' ')
),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
parts AS (
    SELECT lang, a, k, ws, i, unnest(range(2, k)) AS width FROM (SELECT *, unnest(range(1, k)) AS i FROM candidates)
),
within AS (
    SELECT lang, array_to_string(ws[i:i + width - 1], ' ') AS phrase, max(a) AS longer
    FROM parts WHERE i + width - 1 <= k GROUP BY ALL
)"""

_QUALITY = f"""
docs AS (
    SELECT doc_id, coalesce(text, '') AS body, {_WORDS.format("coalesce(text, '')")} AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
    FROM documents
),
windows AS (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, shingle) AS n
    FROM (
        SELECT doc_id, unnest(range(1, len(ws) - 1)) AS p,
            unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) AS shingle
        FROM docs WHERE len(ws) >= 3
    )
),
repeated AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS place FROM windows WHERE n > 1) GROUP BY doc_id
),
measured AS (
    SELECT doc_id, body, ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) AS n_lines,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(list_filter(ws, lambda w: regexp_matches(w, '[A-Za-zÀ-ɏ]'))) AS n_lettered,
        length(regexp_replace(body, '[^A-Z]+', '', 'g')) AS n_capitals,
        len(list_filter(ws, lambda w, i: i > 1 AND w = ws[i - 1])) AS n_stutters
    FROM docs LEFT JOIN repeated USING (doc_id)
)"""

SQL = {
    "op11_phrase_collocations": f"""
WITH {_PHRASES}
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
        phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM lowest LEFT JOIN within USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
) WHERE rank <= 2000""",
    "op13_quality_rules": f"""
WITH {_QUALITY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words
        OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines
        OR 100 * n_capitals > 30 * word_chars OR 100 * (n_words - n_lettered) > 20 * n_words
        OR 100 * n_stutters > 20 * n_words) AS kept
FROM measured""",
    "op5_line_dedup": f"""
WITH {_LINES}
SELECT doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
    sha256(coalesce(string_agg(CASE WHEN g.line IS NULL THEN e.lines[e.line] END, chr(10) ORDER BY e.line), '')) AS kept_sha256
FROM every e LEFT JOIN gone g USING (doc_id, line) GROUP BY doc_id""",
    "op6_exact_dedup": r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)""",
    "op7_benchmark_decontamination": f"""
WITH {_DECONTAMINATION}
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, s.n_shingles, count(*) / s.n_shingles AS containment
FROM in_docs d JOIN in_items i USING (shingle) JOIN sizes s ON s.id = i.id
GROUP BY d.id, i.id, s.n_shingles HAVING count(*) * 100 >= s.n_shingles * 80""",
}
