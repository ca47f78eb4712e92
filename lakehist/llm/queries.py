"""The operators as queries over the test tables, with production parameters, on whole tables and texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehist.llm import chat, language, lm, quality, tokens, urls
from lakehist.llm.decontaminate import contamination
from lakehist.llm.exact import exact_groups
from lakehist.llm.minhash import near_duplicates
from lakehist.llm.mixing import dealt, mix
from lakehist.llm.phrases import collocations
from lakehist.llm.sharding import hilbert_shards, laid_out
from lakehist.llm.spelling import spelling_variants

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "documents"))


def op2_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = lm.train(docs.where(~lm.held_out()), order=3)
    scores = lm.scored(docs, model)
    return scores.withColumn("held_out", lm.held_out()).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(_table(spark, sf, "documents"))


def op3_dealt_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The mix itself: a row for every piece of a document in a slot of an output shard."""
    return dealt(_table(spark, sf, "documents"))


def op4_hilbert_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return laid_out(hilbert_shards(_table(spark, sf, "documents"), shards=24))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, and after long numbers and addresses in it are replaced."""
    docs = tokens.redactions(tokens.counted(_table(spark, sf, "documents").select("doc_id", "text")))
    return tokens.recounted(docs).select(
        "doc_id",
        "tokens.n_tokens",
        F.size("tokens.starts").cast("long").alias("n_leaves"),
        F.size("edits").cast("long").alias("n_edits"),
        F.col("edited.n_tokens").alias("edited_tokens"),
        "edited.leaves_encoded",
    )


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_groups(_table(spark, sf, "documents"), keep="largest")


def op7_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    calls, results = chat.calls_of(_table(spark, sf, "conversations"))
    events = chat.linked(calls, results, chat.SCHEMAS)
    return events.withColumn("problems", F.concat_ws("; ", "problems"))


def op7_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn as an event: the calls and results of ``op7_tool_calls``, and the turns of all other roles."""
    turns = _table(spark, sf, "conversations")
    events = chat.linked(*chat.calls_of(turns), chat.SCHEMAS, chat.plain_of(turns))
    return events.withColumn("problems", F.concat_ws("; ", "problems"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = contamination(docs, _table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "contamination.n_words",
        "contamination.n_hit",
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "contamination.items"), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"),
        F.coalesce("contamination.longest.n_words", F.lit(0).cast("long")).alias("n_longest"),
    )


def op9_url_templates(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judged(_table(spark, sf, "pages")).drop("purity")


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    model = language.fit(docs.where(language.in_training()))
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "language.lang_pred", "language.score")


def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(_table(spark, sf, "documents"))


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(_table(spark, sf, "documents"))


def op13_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents; ``kept`` cuts them at the quantile that the share of bad labels asks for."""
    docs, labels = _table(spark, sf, "documents").select("doc_id", "text"), _table(spark, sf, "labels")
    model = quality.fit(docs.where(quality.in_training()), labels.where(quality.in_training()))
    scores = quality.ranked(docs, model).select("doc_id", quality.held_out().alias("held_out"), "quality.margin", "quality.score")
    return quality.thresholded(scores, 1 - model.preferred).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


QUERIES: dict[str, Query] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_mixing": op3_mixing,
    "op3_dealt_blocks": op3_dealt_blocks,
    "op4_hilbert_sharding": op4_hilbert_sharding,
    "op5_token_counts": op5_token_counts,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_tool_calls": op7_tool_calls,
    "op7_conversations": op7_conversations,
    "op8_decontamination": op8_decontamination,
    "op9_url_templates": op9_url_templates,
    "op10_language": op10_language,
    "op11_spelling": op11_spelling,
    "op12_collocations": op12_collocations,
    "op13_quality": op13_quality,
}

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _ASCII_LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _url_rules() -> str:
    """The longest rule that fits, as SQL."""
    longest_first = sorted(urls.RULES, key=lambda r: -len(r.text))
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'" for r in longest_first
    ) + " END"


def _url_merge(before: str, after: str, level: int) -> str:
    """Segment ``level`` of sibling templates becomes a wildcard where their labelled pages are alike."""
    return f"""
        {after}_keyed AS (
          SELECT *, now[1:{level} - 1] AS b4, now[{level} + 1:] AS af, now[{level}] AS seg FROM {before} WHERE len(now) >= {level}),
        {after}_kids AS (SELECT host, b4, af, seg, sum(labelled) AS n, sum(blocked) AS b FROM {after}_keyed GROUP BY ALL),
        {after}_families AS (
          SELECT host, b4, af, sum(n) AS fn, sum(b) AS fb, count(*) FILTER (n > 0) AS kinds,
            coalesce(sum(b * b / n) FILTER (n > 0), 0) AS squares
          FROM {after}_kids GROUP BY host, b4, af),
        {after}_alike AS (
          SELECT host, b4, af FROM {after}_families
          WHERE kinds >= 2 AND (fb = 0 OR fb = fn OR squares - fb * fb / fn <= fb / fn * (1 - fb / fn) * (kinds - 1 + 2 * sqrt(2.0 * (kinds - 1))))),
        {after} AS (
          SELECT k.host, template, b4 || [CASE WHEN a.host IS NULL THEN seg ELSE '*' END] || af AS now, labelled, blocked
          FROM {after}_keyed k LEFT JOIN {after}_alike a USING (host, b4, af)
          UNION ALL SELECT host, template, now, labelled, blocked FROM {before} WHERE len(now) < {level})"""


# Paths of up to four segments; those of the test tables have two.
_URL_TEMPLATES = f"""
        WITH rest AS (
          SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        split AS (
          SELECT page_id, {_ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        urls AS (
          SELECT *, {_url_rules()} AS rule,
            [regexp_replace(x, '[0-9]+', '#', 'g') for x in string_split(path, '/') if x <> ''] AS own
          FROM (SELECT host, path, count(*) AS pages FROM split GROUP BY host, path)),
        steps AS (
          SELECT host, path, pages, nth, own[nth] AS child, array_to_string(own[1:nth - 1], '/') AS parent
          FROM (SELECT *, unnest(generate_series(1, len(own))) AS nth FROM urls)),
        children AS (SELECT host, nth, parent, child, CAST(sum(pages) AS DOUBLE) AS n FROM steps GROUP BY ALL),
        varied AS (
          SELECT host, nth, parent, sum(n) AS whole FROM children GROUP BY host, nth, parent
          HAVING sum(n) * sum(n) > {urls.VARIED} * sum(n * n)),
        wild AS (SELECT host, nth, parent, child FROM children JOIN varied USING (host, nth, parent) WHERE {urls.RARE} * n < whole),
        told AS (
          SELECT s.host, s.path, list(CASE WHEN w.host IS NULL THEN child ELSE '*' END ORDER BY nth) AS template
          FROM steps s LEFT JOIN wild w USING (host, nth, parent, child) GROUP BY s.host, s.path),
        known AS (
          SELECT u.host, u.path, pages, rule, coalesce(template, []) AS template,
            CASE {" ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in urls.RULES)} END AS label
          FROM urls u LEFT JOIN told t ON t.host = u.host AND t.path = u.path),
        counts AS (
          SELECT host, template, template AS now, CAST(sum(CASE WHEN label IS NULL THEN 0 ELSE pages END) AS DOUBLE) AS labelled,
            CAST(sum(CASE WHEN label = 'block' THEN pages ELSE 0 END) AS DOUBLE) AS blocked
          FROM known GROUP BY host, template),
        {", ".join(_url_merge("counts" if n == 4 else f"merged{n + 1}", f"merged{n}", n) for n in (4, 3, 2, 1))},
        overall AS (SELECT (sum(blocked) + 1) / (sum(labelled) + 2) AS share FROM merged1),
        purity AS (
          SELECT host, now, (b + {urls.SMOOTHING} * wide) / (n + {urls.SMOOTHING}) AS purity
          FROM (SELECT host, now, sum(labelled) AS n, sum(blocked) AS b FROM merged1 GROUP BY host, now)
          JOIN (SELECT now, (sum(blocked) + {urls.SMOOTHING} * any_value(share)) / (sum(labelled) + {urls.SMOOTHING}) AS wide
            FROM merged1, overall GROUP BY now) USING (now))
        SELECT page_id, host, path, rule,
          coalesce(label, CASE WHEN purity > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, '/' || array_to_string(now, '/') AS template
        FROM split JOIN known USING (host, path) JOIN merged1 USING (host, template) JOIN purity USING (host, now)"""

ORACLE: dict[str, str] = {
    "op7_tool_calls": r"""
        WITH RECURSIVE turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
        calls AS (
          SELECT conv_id, turn, 'call-' || conv_id || '-' || turn AS id, to_json(text) AS said,
            len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, len(regexp_extract_all(text, '\.')) AS sentences
          FROM turns WHERE role = 'user'),
        chain AS (
          SELECT conv_id, turn, 0 AS level FROM calls c
          WHERE NOT EXISTS (SELECT 1 FROM calls b WHERE b.conv_id = c.conv_id AND b.turn = c.turn - 2)
          UNION ALL
          SELECT c.conv_id, c.turn, chain.level + 1 FROM calls c JOIN chain ON chain.conv_id = c.conv_id AND chain.turn = c.turn - 2)
        SELECT conv_id, CAST(level AS BIGINT) AS level, 0 AS kind, turn, id AS call_id,
          CASE WHEN words < 24 THEN 'search' ELSE 'summarise' END AS name,
          CASE WHEN level = 0 AND turn >= 2 THEN 'dangling'
            WHEN EXISTS (SELECT 1 FROM turns t WHERE t.role = 'assistant' AND t.conv_id = calls.conv_id AND t.turn = calls.turn + 1)
            THEN 'linked' ELSE 'unanswered' END AS status,
          CASE WHEN words >= 24 THEN '' WHEN sentences < 1 THEN 'limit too small' WHEN sentences > 3 THEN 'limit too large'
            ELSE '' END AS problems,
          '{"arguments":' || CASE WHEN words < 24 THEN '{"limit":' || sentences || ',"query":' || said || '}'
            ELSE '{"text":' || said || ',"words":' || words || '}' END
          || ',"id":"' || id || '","name":"' || CASE WHEN words < 24 THEN 'search' ELSE 'summarise' END
          || '","role":"call","turn":' || turn || '}' AS json
        FROM calls JOIN chain USING (conv_id, turn)
        UNION ALL
        SELECT t.conv_id, CAST(coalesce(level, 0) AS BIGINT), 1, t.turn, 'call-' || t.conv_id || '-' || (t.turn - 1), NULL,
          CASE WHEN level IS NULL THEN 'orphan' ELSE 'linked' END, '',
          '{"content":' || to_json(text) || ',"id":"call-' || t.conv_id || '-' || (t.turn - 1) || '","role":"result","turn":' || t.turn || '}'
        FROM turns t LEFT JOIN chain ON chain.conv_id = t.conv_id AND chain.turn = t.turn - 1 WHERE role = 'assistant'""",
    "op9_url_templates": _URL_TEMPLATES,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op8_decontamination": f"""
        WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
        i AS (SELECT item_id, row_number() OVER () AS nth, {_WORDS.format("coalesce(text, '')")} AS ws FROM benchmark),
        windows AS (
          SELECT item_id, nth, least(len(ws), 10) AS n, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS p, ws
          FROM i WHERE len(ws) > 0),
        sought AS (SELECT DISTINCT item_id, nth, p AS q, n, list_aggregate(ws[p:p + n - 1], 'string_agg', ' ') AS words FROM windows),
        places AS (
          SELECT doc_id, n, unnest(generate_series(1, len(ws) - n + 1)) AS p, ws
          FROM w, (SELECT DISTINCT n FROM sought) WHERE len(ws) >= n),
        hits AS (
          SELECT DISTINCT doc_id, item_id, nth, p, q, n
          FROM (SELECT doc_id, n, p, list_aggregate(ws[p:p + n - 1], 'string_agg', ' ') AS words FROM places)
          JOIN sought USING (n, words)),
        covered AS (
          SELECT doc_id, count(DISTINCT q) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY doc_id),
        longest AS (
          SELECT doc_id, max(words) AS n_longest
          FROM (SELECT doc_id, n - 1 + count(*) AS words
            FROM (SELECT doc_id, nth, p - q AS diagonal, n, p - row_number() OVER (PARTITION BY doc_id, nth, p - q ORDER BY p) AS island FROM hits)
            GROUP BY doc_id, nth, diagonal, n, island)
          GROUP BY doc_id),
        owners AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
          sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
          coalesce(n_longest, 0) AS n_longest
        FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id) LEFT JOIN longest USING (doc_id)""",
}

#: The calls and results as above, and all other turns.
ORACLE["op7_conversations"] = ORACLE["op7_tool_calls"] + r"""
        UNION ALL
        SELECT conv_id, 0, 2, turn, NULL, NULL, 'plain', '',
          '{"content":' || to_json(text) || coalesce(',"role":' || to_json(role), '') || ',"turn":' || turn || '}'
        FROM turns WHERE role IS NULL OR role NOT IN ('user', 'assistant')"""

ORACLE["op12_collocations"] = f"""
        WITH lowered AS (SELECT coalesce(lang, 'und') AS lang, {_ASCII_LOWER.format("coalesce(text, '')")} AS t FROM documents),
        pieces AS (
          SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
          FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered)),
        places AS (
          SELECT lang, ws, d, unnest(generate_series(1, len(ws) - d + 1)) AS p
          FROM pieces, (VALUES (1), (2), (3), (4)) AS depths(d) WHERE len(ws) >= d),
        grams AS (SELECT lang, d, ws[p:p + d - 1] AS g, count(*) AS f FROM places GROUP BY ALL),
        candidates AS (SELECT lang, d, g, f AS a FROM grams WHERE d > 1 AND f >= 30),
        cuts AS (
          SELECT c.lang, c.d, c.g, c.a, k, l.f AS l, r.f AS r, (CAST(2000000 AS HUGEINT) * c.a) // (l.f + r.f) AS score
          FROM (SELECT *, unnest(generate_series(1, d - 1)) AS k FROM candidates) c
          JOIN grams l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN grams r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
        inner_parts AS (
          SELECT lang, f, g[p:p + e - 1] AS g
          FROM (SELECT lang, a AS f, g, e, unnest(generate_series(1, d - e + 1)) AS p
            FROM candidates, (VALUES (2), (3)) AS lengths(e) WHERE e < d)),
        longer AS (SELECT lang, g, max(f) AS f FROM inner_parts GROUP BY lang, g),
        kept AS (
          SELECT c.*, array_to_string(c.g, ' ') AS phrase FROM lowest c LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g
          WHERE o.f IS NULL OR 100 * o.f < 80 * c.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
          CAST(score AS BIGINT) AS score
        FROM kept JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE d = 1 GROUP BY lang) USING (lang)
        QUALIFY rank <= 2000"""

# The checksum takes a bit at a time; letters are one byte, or 195 and another.
ORACLE["op11_spelling"] = f"""
        WITH RECURSIVE lowered AS (
          SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, {_ASCII_LOWER.format("coalesce(text, '')")} AS t FROM documents),
        runs AS (
          SELECT id, run, count(*) AS n
          FROM (SELECT id, unnest(regexp_extract_all(t, '[a-zÀ-ÿ]+')) AS run FROM lowered) WHERE len(run) >= 6 GROUP BY id, run),
        bits AS (
          SELECT run, n, flatten(list_transform(
            flatten(list_transform(string_split(id || ':' || run, ''),
              lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)),
            lambda b: [b & 1, (b >> 1) & 1, (b >> 2) & 1, (b >> 3) & 1, (b >> 4) & 1, (b >> 5) & 1, (b >> 6) & 1, (b >> 7) & 1])) AS bits
          FROM runs),
        sums AS (
          SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(bits, lambda b: CAST(b AS BIGINT)),
            lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h
          FROM bits),
        words AS (
          SELECT word, CAST(sum(n) AS BIGINT) AS n
          FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word FROM sums)
          WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cut AS (
          SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
          FROM (SELECT word, n, unnest(generate_series(1, len(word))) AS p FROM words)),
        near AS (
          SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (p, rest) WHERE a.word <> b.word
          UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON words.word = cut.rest
          UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON words.word = cut.rest),
        best AS (
          SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
          QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
        told AS (
          SELECT word, CASE WHEN other_n >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
            CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
          FROM words LEFT JOIN best USING (word)),
        followed AS (
          SELECT word, word AS reached FROM told
          UNION ALL SELECT f.word, t.form FROM followed f JOIN told t ON t.word = f.reached WHERE t.form IS NOT NULL)
        SELECT told.word, told.form, reached AS root, told.n, told.n_near, told.form_n
        FROM told JOIN followed USING (word) JOIN told last ON last.word = reached AND last.form IS NULL"""

# Every pair of texts that share a shingle is compared, and links are followed to their ends.
ORACLE["op1_minhash_dedup"] = f"""
        WITH RECURSIVE texts AS (
          SELECT row_number() OVER () AS node, t, regexp_extract_all({_ASCII_LOWER.format("t")}, '[^\x20\x09-\x0D]+') AS ws
          FROM (SELECT DISTINCT coalesce(text, '') AS t FROM documents)),
        shingles AS (
          SELECT DISTINCT node, ws[p:p + least(len(ws), 5) - 1] AS s
          FROM (SELECT node, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS p FROM texts WHERE len(ws) > 0)),
        sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node),
        shared AS (
          SELECT a.node AS u, b.node AS v, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.node <> b.node GROUP BY a.node, b.node),
        links AS (
          SELECT u, v FROM shared JOIN sizes a ON a.node = u JOIN sizes b ON b.node = v WHERE 10 * k >= 8 * (a.n + b.n - k)),
        reached AS (SELECT node, node AS other FROM texts UNION SELECT r.node, v FROM reached r JOIN links ON u = r.other),
        classes AS (SELECT node, min(other) AS class FROM reached GROUP BY node),
        rows_of AS (SELECT doc_id, class FROM documents d JOIN texts ON t = coalesce(d.text, '') JOIN classes USING (node))
        SELECT doc_id, min(doc_id) OVER same AS class_id, count(*) OVER same AS class_size,
          doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept
        FROM rows_of WINDOW same AS (PARTITION BY class)"""
