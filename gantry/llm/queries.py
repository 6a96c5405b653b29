"""One query for each operator, over the whole of its table, with SQL counterparts.

Operators without SQL counterpart are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm import (
    chat,
    decontaminate,
    exact_dedup,
    licenses,
    lm,
    mixing,
    ngram_join,
    phrases,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
    whitening,
)
from gantry.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@_query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


@_query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_scores(read_table(spark, sf_dir, "documents"))


@_query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents"))


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read_table(spark, sf_dir, "documents"))


@_query
def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


@_query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


@_query
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


ORACLES["op7_source_mix"] = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5(concat(coalesce(CAST(doc_id AS VARCHAR), chr(30)), chr(31), coalesce(text, chr(30)))) AS key
    FROM documents
), placed AS (
    SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
    FROM sized
), sources AS (
    SELECT source, source_size, rank,
           CAST([3, 1, 2][rank % 3 + 1] AS DOUBLE) AS weight,
           [CAST(-0.5 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0.5 AS DOUBLE)][rank % 3 + 1] AS slope,
           CAST(source_size * 2 AS DOUBLE) AS most,
           CAST(sum(source_size) OVER () AS BIGINT) * 150 / CAST(100 AS DOUBLE) AS wanted
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
          FROM sized GROUP BY source)
), running AS (
    SELECT *, (wanted - coalesce(sum(most) OVER (ORDER BY most / weight, rank
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY most / weight, rank
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), targets AS (
    SELECT source, source_size, slope,
           least(most, coalesce((SELECT level FROM running WHERE level * weight <= most
                                 ORDER BY most / weight, rank LIMIT 1) * weight, most)) AS target
    FROM running
), taken AS (
    SELECT doc_id, size, source_size, target, slope, start,
           greatest(least(CAST(round(target) AS BIGINT) - start, size), 0) AS first,
           greatest(least(CAST(round(target) AS BIGINT) - source_size - start, size), 0) AS second
    FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
), shares AS (
    SELECT *, least(start / target, 1) AS a, least((start + source_size) / target, 1) AS b FROM taken
)
SELECT doc_id, size, source_size, target, first + second AS taken,
       CASE WHEN first = 0 THEN NULL WHEN slope = 0 THEN round(a, 9)
            ELSE round((sqrt((1 - slope) * (1 - slope) + 4 * slope * a) - (1 - slope)) / (2 * slope), 9) END AS position,
       CASE WHEN second = 0 THEN NULL WHEN slope = 0 THEN round(b, 9)
            ELSE round((sqrt((1 - slope) * (1 - slope) + 4 * slope * b) - (1 - slope)) / (2 * slope), 9) END AS again
FROM shares
"""


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(read_table(spark, sf_dir, "documents"))


@_query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


ORACLES["op10_chat_format"] = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations
), lines AS (
    SELECT *, CAST(floor(turn / 256) AS BIGINT) AS segment,
           '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10) AS line,
           concat_ws(chr(30), coalesce('=' || CAST(turn AS VARCHAR), ''), coalesce('=' || role, ''), coalesce('=' || text, '')) AS content
    FROM turns
), numbers AS (
    -- a prefix takes all rows of a turn number, or none
    SELECT conv_id, turn, count(*) AS rows, string_agg(content, chr(29) ORDER BY content) AS content
    FROM lines GROUP BY conv_id, turn
), prefixes AS (
    SELECT conv_id, CAST(sum(rows) OVER w AS BIGINT) AS n, md5(string_agg(content, chr(29)) OVER w) AS fingerprint,
           CAST(sum(rows) OVER (PARTITION BY conv_id) AS BIGINT) AS n_turns
    FROM numbers
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST ROWS UNBOUNDED PRECEDING)
), whole AS (
    SELECT min(conv_id) AS conv_id, n_turns, fingerprint FROM prefixes WHERE n = n_turns GROUP BY n_turns, fingerprint
), maximal AS (
    SELECT * FROM whole
    WHERE NOT EXISTS (SELECT 1 FROM prefixes p
                      WHERE p.n = whole.n_turns AND p.fingerprint = whole.fingerprint AND p.n < p.n_turns)
)
SELECT l.conv_id, l.segment, CAST(l.nth // 4096 AS BIGINT) AS piece, m.n_turns, string_agg(l.line, '' ORDER BY l.nth) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, segment
                                   ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) - 1 AS nth FROM lines) l
JOIN maximal m ON l.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY ALL
"""


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies_report(read_table(spark, sf_dir, "documents"))


ORACLES["op11_exact_dedup"] = f"""
WITH normalised AS (SELECT doc_id, {_LOWER_SQL} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM normalised WINDOW same AS (PARTITION BY body)
"""


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array({_LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sized AS (
    SELECT lang, w, unnest([1, 2, 3, 4]) AS size FROM worded
), grams AS (
    SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM sized WHERE len(w) >= size
), counted AS (
    SELECT lang, size, w[i:i + size - 1] AS words, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), cuts AS (
    SELECT lang, size, words, f AS a, unnest(range(1, size)) AS k FROM counted WHERE size > 1
), scored AS (
    SELECT c.lang, c.size, c.words, c.a, c.k, x.f AS l, y.f AS r,
           CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
    FROM cuts c JOIN counted x ON x.lang = c.lang AND x.words = c.words[1:c.k]
    JOIN counted y ON y.lang = c.lang AND y.words = c.words[c.k + 1:c.size]
), worst AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inner_sizes AS (
    SELECT lang, size, words, f, unnest(range(2, size)) AS inner_size FROM counted WHERE size > 2
), inside AS (
    SELECT lang, words, inner_size, f, unnest(range(1, size - inner_size + 2)) AS i FROM inner_sizes
), contained AS (
    SELECT lang, words[i:i + inner_size - 1] AS words, max(f) AS within FROM inside GROUP BY ALL
), free AS (
    SELECT w.* FROM worst w LEFT JOIN contained c ON c.lang = w.lang AND c.words = w.words
    WHERE c.within IS NULL OR 100 * c.within < 80 * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank
    FROM free
) JOIN totals USING (lang) WHERE rank <= 2000
"""


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_vectors(read_table(spark, sf_dir, "embeddings"))
