"""Registered queries of the corpus operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from . import (
    chosen_path,
    decontaminate,
    filter_audit,
    html_lstm,
    language_hd,
    mixing,
    period_runs,
    quality_fm,
    quality_rules,
    secrets,
    substring_dedup,
    warc,
)
from . import ngram_join as ngram_join_op
from .common import read_table, text_of

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return keep


# ---------------------------------------------------------------- secret scans

_SPLIT_SQL = """
  SELECT doc_id, {kind_no} AS kind_no, '{kind}' AS kind, text, unnest(range(1, len(hits) + 1)) AS i, hits, parts, gaps
  FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}', 0) AS hits,
               regexp_extract_all(text, '{pattern}', {group}) AS parts,
               regexp_split_to_array(text, '{pattern}') AS gaps FROM d)"""


def _split_sql(kind_no: int, kind: str, pattern: str, group: int) -> str:
    return _SPLIT_SQL.format(kind_no=kind_no, kind=kind, pattern=pattern.replace("'", "''"), group=group)


def _secrets_sql() -> str:
    allow = " OR ".join(f"regexp_matches(hit, '{p}')" for p in secrets.ALLOW)
    table = "[" + ", ".join(str(secrets.plogp(c)) for c in range(secrets.WINDOW + 1)) + "]"
    low, high = (secrets.most_plogp(secrets.THRESHOLD_BITS[k]) for k in ("hex", "mixed"))
    w = secrets.WINDOW
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_split_sql(0, 'assign', secrets.ASSIGN, 2)}
  UNION ALL {_split_sql(1, 'access', secrets.ACCESS, 0)}
  UNION ALL {_split_sql(2, 'hex', secrets.HEX, 0)}
  UNION ALL {_split_sql(3, 'entropy', secrets.CANDIDATE, 0)}),
placed AS (SELECT doc_id, kind_no, kind, hits[i] AS hit, length(parts[i]) AS part_length,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s FROM m),
base AS (SELECT doc_id, kind_no, kind, CAST(s AS BIGINT) AS s, CAST(s + length(hit) AS BIGINT) AS e FROM placed
  WHERE kind_no < 3 AND (kind_no > 0 OR part_length >= 8)),
cand AS (SELECT doc_id, hit, s, CASE WHEN regexp_matches(hit, '^[0-9A-Fa-f]+$') THEN {low} ELSE {high} END AS most
  FROM placed WHERE kind_no = 3 AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND NOT ({allow})),
win AS (SELECT doc_id, s, most, hit, unnest(range(0, length(hit) - {w} + 1)) AS o FROM cand),
chars AS (SELECT doc_id, s, most, o, unnest(string_split(substr(hit, CAST(o + 1 AS BIGINT), {w}), '')) AS c FROM win),
counts AS (SELECT doc_id, s, most, o, c, count(*) AS n FROM chars GROUP BY ALL),
hot AS (SELECT doc_id, s, o FROM counts GROUP BY doc_id, s, most, o HAVING sum(({table})[n + 1]) <= most),
marked AS (SELECT *, CASE WHEN o <= lag(o) OVER (PARTITION BY doc_id, s ORDER BY o) + {w} THEN 0 ELSE 1 END AS fresh FROM hot),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, s ORDER BY o) AS run FROM marked),
ent AS (SELECT doc_id, 3 AS kind_no, 'entropy' AS kind, CAST(s + min(o) AS BIGINT) AS s, CAST(s + max(o) + {w} AS BIGINT) AS e
  FROM runs GROUP BY doc_id, runs.s, run),
spans AS (SELECT * FROM base UNION ALL
  SELECT * FROM ent WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = ent.doc_id AND b.s <= ent.s AND ent.e <= b.e)),
agg AS (SELECT doc_id,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) FILTER (WHERE kind_no < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS spans,
    count(*) FILTER (WHERE kind_no = 0) AS n_assign, count(*) FILTER (WHERE kind_no = 1) AS n_access,
    count(*) FILTER (WHERE kind_no = 2) AS n_hex, count(*) FILTER (WHERE kind_no = 3) AS n_entropy
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM d LEFT JOIN agg USING (doc_id)"""


@query("op2_secret_scan", _secrets_sql())
def secret_scan(spark, sf_dir):
    """Base and entropy spans of every document."""
    return secrets.report(read_table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- mixing

_W, _CAP = mixing.WEIGHTS, mixing.CAP


@query("op4_mix_sources", f"""
WITH d AS (SELECT doc_id, source, len({WORDS_SQL}) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, {_CAP} * source_size AS lim,
  {list(_W)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(_W)} + 1] AS weight FROM s),
c AS (SELECT *, lim / weight AS ratio,
  coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lim_before,
  coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before,
  sum(source_size) OVER () AS words, sum(weight) OVER () AS all_weight
  FROM w WINDOW o AS (ORDER BY lim / weight, source NULLS LAST)),
l AS (SELECT *, (words - lim_before)::DOUBLE / (all_weight - weight_before)::DOUBLE AS level FROM c),
t AS (SELECT source, source_size, least(lim::DOUBLE, (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio) * weight) AS target FROM l),
p AS (SELECT doc_id, size, CAST(t.source_size AS BIGINT) AS source_size, target, CAST(floor(target) AS BIGINT) AS budget,
  sum(size) OVER (PARTITION BY d.source ORDER BY md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE CAST(
  (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) AS BIGINT) END AS taken
FROM p""")
def mix_sources(spark, sf_dir):
    """All documents' words mixed to the source weights."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- quality rules

def _rules_sql() -> str:
    symbols = "[#*$%&|<>]"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
c AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '{symbols}', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS capitals,
    coalesce(list_max(list_transform(ws, lambda w: length(w))), 0) AS longest
  FROM d LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_dup_lines > 50 * n_lines
    OR 100 * letters < 60 * word_chars OR 100 * capitals > 50 * letters OR longest > 1000) AS kept
FROM c"""


@query("op10_quality_rules", _rules_sql())
def quality_cascade(spark, sf_dir):
    """Counters of every document, and the cascade's verdict."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.cascade(quality_rules.counters(docs), quality_rules.default_rules(), sample_from=docs,
                                   prepare=quality_rules.counters)
    base = quality_rules.base_rules()
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (base[0].rejects() | base[1].rejects()).alias("base_failed"), "kept")


# ---------------------------------------------------------------- substring dedup

@query("op7_substring_dedup", rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(g)) AS owner FROM win) WHERE owner < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit),
kept AS (SELECT w.doc_id, count(*) AS n, string_agg(w.w, ' ' ORDER BY w.i) AS k
  FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d) w
  ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def substring_repeats(spark, sf_dir):
    """Words outside every repeated window, of every document."""
    done = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# ---------------------------------------------------------------- n-gram Jaccard join

@query("op6_ngram_join")
def ngram_join(spark, sf_dir):
    """Components of documents whose 4-word shingle sets are 85% alike."""
    return ngram_join_op.link_components(read_table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- quality classifier

@query("op3_quality_fm")
def quality_scores(spark, sf_dir):
    """Quality score of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_fm.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model, keep=["doc_id"]).select(
        "doc_id", F.coalesce(quality_fm.fold("doc_id", quality_fm.FOLDS) == quality_fm.HELD_OUT, F.lit(False)).alias("held_out"),
        "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


# ---------------------------------------------------------------- language identification

@query("op5_language_hd")
def languages(spark, sf_dir):
    """Predicted language of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_hd.predict(docs, language_hd.learn(docs))
    return found.select("doc_id", F.coalesce(quality_fm.fold("doc_id", language_hd.FOLDS) == language_hd.HELD_OUT,
                                             F.lit(False)).alias("held_out"), "lang_pred", "score")


# ---------------------------------------------------------------- benchmark decontamination

@query("op8_benchmark_hits")
def benchmark_hits(spark, sf_dir):
    """Documents and the benchmark items that they hold."""
    return decontaminate.hits(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                              read_table(spark, sf_dir, "benchmark"))


# ---------------------------------------------------------------- HTML extraction

@query("op9_main_text")
def main_text(spark, sf_dir):
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_lstm.extract(pages, html_lstm.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# ---------------------------------------------------------------- WARC

@query("op1_warc_round_trip", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""")
def warc_round_trip(spark, sf_dir):
    """Every page written to WARC, normalised and read back."""
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------- filter interaction audit

@query("op12_filter_audit", f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS_SQL} AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step, bits FROM o),
t AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before FROM s),
r AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, t GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r""")
def filters_in_every_order(spark, sf_dir):
    """Five filters over all documents, in all 120 orders, per language."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, read_table(spark, sf_dir, "labels"))


# ---------------------------------------------------------------- periodic runs

@query("op13_periodic_runs")
def word_runs(spark, sf_dir):
    """Runs of every document, a tenth of them made periodic by their id's hash."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    planted = docs.select("doc_id", period_runs.with_period(text_of("text"), F.col("doc_id")).alias("text"))
    return period_runs.report(period_runs.periodic_runs(planted))


# ---------------------------------------------------------------- chosen-path near duplicates

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query("op11_chosen_path", f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL} AS ws
  FROM (SELECT doc_id, translate(text, '{_LETTERS}', '{_LETTERS.lower()}') AS text FROM documents)),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT g, count(*) AS f FROM s GROUP BY g),
-- two linked sets share one of the rarest n - ceil(0.8 n) + 1 shingles of each
rare AS (SELECT doc_id, g FROM s JOIN n USING (doc_id) JOIN f USING (g)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY f, g) <= n - (80 * n + 99) // 100 + 1),
cand AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM rare x JOIN rare y ON x.g = y.g AND x.doc_id < y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)),
shared AS (SELECT a, b, count(*) AS o FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY a, b),
link AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
reach AS (SELECT a AS x, b AS y FROM link UNION SELECT b, a FROM link
  UNION SELECT r.x, l.y FROM reach r JOIN (SELECT a AS x, b AS y FROM link UNION ALL SELECT b, a FROM link) l ON r.y = l.x),
low AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.x = w.doc_id""")
def chosen_path_duplicates(spark, sf_dir):
    """Components of documents whose 2-word shingle sets are 80% alike."""
    return chosen_path.link_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
