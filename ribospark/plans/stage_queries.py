"""Registered queries over stage plumbing, mature arms and models, and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ribospark.functions import features as ft
from ribospark.functions import sequence as sq
from ribospark.functions import structure as st
from ribospark.operators import collapse, islands, labels, mature, models, negatives, stages, stats
from ribospark.plans import queries as q
from ribospark.plans import views as v

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# Reads, ids and coordinates.


@query("p1_trim_adapter", f"WITH {v.SEQUENCES} SELECT id, CASE WHEN instr(seq, 'GUACA') > 0 THEN substr(seq, 1, instr(seq, 'GUACA') - 1) ELSE seq END AS seq FROM sequences WHERE length(CASE WHEN instr(seq, 'GUACA') > 0 THEN substr(seq, 1, instr(seq, 'GUACA') - 1) ELSE seq END) BETWEEN 18 AND 30")
def p1_trim_adapter(spark, d):
    return stages.trim_adapter(v.sequences(spark, d), "GUACA")


@query("p2_trim_discard", f"WITH {v.SEQUENCES} SELECT id, substr(seq, 1, instr(seq, 'GUACA') - 1) AS seq FROM sequences WHERE instr(seq, 'GUACA') - 1 BETWEEN 18 AND 30")
def p2_trim_discard(spark, d):
    return stages.trim_adapter(v.sequences(spark, d), "GUACA", untrimmed=False)


@query("p15_n_free", "SELECT doc_id, NOT contains(upper(text), 'N') AS n_free FROM documents WHERE text IS NOT NULL")
def p15_n_free(spark, d):
    return v.load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", stages.n_free(F.col("text")).alias("n_free"))


TAGS = """tags AS (SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN 'N1|orig=' || p_name WHEN 1 THEN 'N2_chrX_' || p_partkey || '_' || (p_partkey + 50) WHEN 2 THEN 'N3|source=a:chr' || p_size || ':5-' || p_partkey
  WHEN 3 THEN 'mir-' || p_partkey || '-5P extra' WHEN 4 THEN 'mir*_' || p_partkey || '_pre' ELSE 'let-' || p_partkey || '-star-3p' END AS tag FROM part)"""


def _tags(spark, d):
    k, text = F.col("p_partkey"), lambda c: F.col(c).cast("string")
    forms = [F.concat(F.lit("N1|orig="), "p_name"), F.concat(F.lit("N2_chrX_"), text("p_partkey"), F.lit("_"), (k + 50).cast("string")), F.concat(F.lit("N3|source=a:chr"), text("p_size"), F.lit(":5-"), text("p_partkey"))]
    forms += [F.concat(F.lit("mir-"), text("p_partkey"), F.lit("-5P extra")), F.concat(F.lit("mir*_"), text("p_partkey"), F.lit("_pre")), F.concat(F.lit("let-"), text("p_partkey"), F.lit("-star-3p"))]
    return v.load(spark, d, "part").select(k.alias("k"), F.element_at(F.array(*forms), (k % 6 + 1).cast("int")).alias("tag"))


@query("p27_header_coords", f"WITH {TAGS}, m AS (SELECT k, CASE WHEN regexp_matches(tag, '(chr\\w+):(\\d+)-(\\d+)') THEN '(chr\\w+):(\\d+)-(\\d+)' WHEN regexp_matches(tag, '(chr\\w+)_(\\d+)_(\\d+)') THEN '(chr\\w+)_(\\d+)_(\\d+)' END AS p, tag FROM tags), e AS (SELECT k, CASE WHEN p LIKE '%:%' THEN regexp_extract(tag, '(chr\\w+):(\\d+)-(\\d+)', ['c', 's', 'e']) WHEN p IS NOT NULL THEN regexp_extract(tag, '(chr\\w+)_(\\d+)_(\\d+)', ['c', 's', 'e']) END AS x FROM m) SELECT k, x.c AS chrom, x.s::BIGINT AS start, x.e::BIGINT AS \"end\" FROM e")
def p27_header_coords(spark, d):
    return _tags(spark, d).select("k", stages.header_coords(F.col("tag")).alias("c")).select("k", "c.chrom", "c.start", "c.end")


@query("p29_p31_s16_ids", f"WITH {TAGS} SELECT k, CASE WHEN regexp_matches(tag, '^N[123][|_]') THEN substr(tag, 1, 2) ELSE 'unknown' END AS bucket, regexp_replace(regexp_replace(split_part(tag, ' ', 1), '-(5p|3p)$', '', 'i'), '-(mature|star|loop)$', '', 'i') AS parent, regexp_replace(replace(split_part(tag, ' ', 1), '*', ''), '_[^_]*$', '') AS base, starts_with(tag, 'mir') AS is_mir FROM tags")
def p29_p31_s16_ids(spark, d):
    t = F.col("tag")
    x = _tags(spark, d)
    mine = stages.species_filter(x, "mir", "tag").select("k", F.lit(True).alias("is_mir"))
    return x.join(mine, "k", "left").select("k", stages.bucket_of(t).alias("bucket"), stages.parent_id(t).alias("parent"), stages.base_hairpin_id(t).alias("base"), F.coalesce("is_mir", F.lit(False)).alias("is_mir"))


@query("v16_negative_index", f"WITH {TAGS} SELECT split_part(tag, '|', 1) AS bucket, tag AS id, length(tag)::INT AS len, substr(tag, length(split_part(tag, '|', 1)) + 2) AS provenance FROM tags")
def v16_negative_index(spark, d):
    return stages.negative_index(_tags(spark, d).select(F.col("tag").alias("id"), F.col("tag").alias("seq")))


@query("p22_genomic", f"WITH {v.SCORED} SELECT candidate_id, CASE WHEN strand = '+' THEN start0 + 5 ELSE start0 + 200 - hp_len END AS hp_start0, CASE WHEN strand = '+' THEN start0 + hp_len ELSE start0 + 195 END AS hp_end0 FROM scored")
def p22_genomic(spark, d):
    x = v.scored(spark, d)
    g = stages.genomic(F.col("strand"), F.col("start0"), F.col("start0") + 200, F.lit(5), F.col("hp_len"))
    return x.select("candidate_id", *[c.alias(k) for k, c in g.items()])


INTERVALS = f"""{v.SCORED}, iv AS (SELECT candidate_id, strand, start0 AS peak_center0, CASE WHEN start0 % 4 = 0 THEN 'NA' ELSE pad::VARCHAR END AS best_pad, CASE WHEN start0 % 3 = 0 THEN 'NA' ELSE (start0 + 4)::VARCHAR END AS hs, (start0 + 4 + start0 % 2 * hp_len)::VARCHAR AS he,
  start0 - 9 AS bs, CASE WHEN start0 % 5 = 0 THEN start0 - 9 ELSE start0 + 30 END AS be FROM scored)"""


@query("p23_query_interval", f"""WITH {INTERVALS}, n AS (SELECT *, coalesce(try_cast(he AS BIGINT) > try_cast(hs AS BIGINT), false) AS h, be > bs AS b, coalesce(try_cast(best_pad AS BIGINT), 70) AS p FROM iv)
SELECT candidate_id, CASE WHEN h THEN hs::BIGINT WHEN b THEN bs ELSE greatest(0, peak_center0 - p) END AS q_start0, CASE WHEN h THEN he::BIGINT WHEN b THEN be ELSE peak_center0 + p + 1 END AS q_end0, strand AS q_strand FROM n""")
def p23_query_interval(spark, d):
    s = F.col("start0")
    x = v.scored(spark, d).select("candidate_id", "strand", s.alias("peak_center0"), F.when(s % 4 == 0, "NA").otherwise(F.col("pad").cast("string")).alias("best_pad"), F.when(s % 3 == 0, "NA").otherwise((s + 4).cast("string")).alias("best_hp_start0"), (s + 4 + s % 2 * F.col("hp_len")).cast("string").alias("best_hp_end0"), (s - 9).alias("best_start0"), F.when(s % 5 == 0, s - 9).otherwise(s + 30).alias("best_end0"))
    return x.select("candidate_id", *[c.alias(k) for k, c in stages.query_interval(x).items()])


@query("p24_p25_p26_keys", f"WITH {v.SCORED} SELECT candidate_id, regexp_replace(candidate_id, '\\|pad\\d+$', '') AS base_id, pad, 'NA|' || chrom || '|' || strand || '|' || start0 || '|NA' AS peak_key, CASE WHEN start0 % 2 = 0 THEN 'peak_id:' || base_id ELSE 'NA|' || chrom || '|' || strand || '|' || start0 || '|NA' END AS mixed_key, CASE WHEN start0 % 2 = 0 THEN base_id ELSE 'NA|NA|' || start0 || '|NA' END AS peak_id FROM scored")
def p24_p25_p26_keys(spark, d):
    x = v.scored(spark, d).withColumn("peak_center0", F.col("start0"))
    parts = stages.split_candidate_id(F.col("candidate_id"))
    y = x.withColumn("peak_id", F.when(F.col("start0") % 2 == 0, F.col("base_id")))
    return y.select("candidate_id", parts["base_id"].alias("base_id"), parts["pad"].alias("pad"), stages.peak_key(x).alias("peak_key"), stages.peak_key(y).alias("mixed_key"), stages.synth_peak_id(y).alias("peak_id"))


GENOME = f"genome AS (SELECT 'c' || doc_id AS chrom, s, (doc_id * 37) % length(s) AS c, CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM (SELECT doc_id, translate(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'), '{v.FROM}', '{v.TO}') AS s FROM documents) WHERE length(s) > 0)"


def _genome(spark, d, size):
    from ribospark.sources.readers import genome_chunks

    s = F.translate(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""), v.FROM, v.TO)
    docs = v.load(spark, d, "documents").select("doc_id", s.alias("seq")).where("seq <> ''")
    peaks = docs.select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("chrom"), F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-").alias("strand"), (F.col("doc_id") * 37 % F.length("seq")).alias("center0"))
    return peaks, genome_chunks(docs.select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id"), "seq"), size)


@query("s10_fetch", f"WITH {GENOME} SELECT chrom, c - 30 AS start0, c + 170 AS end0, substr(s, greatest(c - 30, 0) + 1, c + 170 - greatest(c - 30, 0)) AS fetched FROM genome")
def s10_fetch(spark, d):
    from ribospark.sources.readers import fetch

    peaks, chunks = _genome(spark, d, 64)
    return fetch(peaks.select("chrom", (F.col("center0") - 30).alias("start0"), (F.col("center0") + 170).alias("end0")), chunks, 64)


@query("x10_excision", f"""WITH {GENOME}, x AS (SELECT chrom || '|' || strand || '|pad' || pad AS candidate_id, greatest(c - pad, 0) AS start0, c + pad + 1 AS end0, strand, substr(s, greatest(c - pad, 0) + 1, c + pad + 1 - greatest(c - pad, 0)) AS f FROM genome, (VALUES (70), (100)) AS p(pad)),
y AS (SELECT *, CASE WHEN strand = '-' THEN reverse(translate(f, 'ACGTUNacgtun', 'TGCAANtgcaan')) ELSE f END AS seq FROM x)
SELECT candidate_id, start0, end0, seq FROM y WHERE f <> '' AND NOT (len(list_distinct(string_split(replace(seq, 'U', 'T'), ''))) <= 2 OR list_max(list_transform(['A', 'C', 'G', 'T'], lambda z: length(seq) - length(replace(replace(seq, 'U', 'T'), z, '')))) / length(seq) >= 0.8)""")
def x10_excision(spark, d):
    peaks, chunks = _genome(spark, d, 128)
    rows, _ = stages.excise(peaks.withColumn("peak_key", F.concat_ws("|", "chrom", "strand")), chunks, size=128)
    return rows.select("candidate_id", "start0", "end0", "seq")


# Joins between stages.


@query("j11_drop_confirmed", f"WITH {v.SCORED} SELECT candidate_id FROM scored WHERE start0 % 3 <> 0")
def j11_drop_confirmed(spark, d):
    x = v.scored(spark, d).withColumn("peak_center0", F.col("start0"))
    early = x.select("chrom", "strand", "peak_center0", F.when(F.col("start0") % 3 == 0, "Known-Confirmed").otherwise("Unknown").alias("known_early_status"))
    return stages.drop_confirmed(x, early).select("candidate_id")


@query("j12_j17_o12_id_sets", "SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents")
def j12_j17_o12_id_sets(spark, d):
    docs, ids = v.load(spark, d, "documents").select("doc_id"), v.load(spark, d, "labels")
    return stages.keep_ids(docs, ids, "doc_id").withColumn("labelled", F.lit(True)).unionAll(stages.drop_ids(docs, ids, "doc_id").withColumn("labelled", F.lit(False)))


@query("j13_complete_join", "SELECT doc_id, quality, n_chars FROM labels JOIN documents USING (doc_id)")
def j13_complete_join(spark, d):
    return stages.complete_join(v.load(spark, d, "labels").select("doc_id", "quality"), v.load(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")


@query("j14_with_known", f"WITH {v.SCORED} SELECT candidate_id, CASE WHEN start0 % 2 = 0 THEN 'Known-Atypical' ELSE 'Unknown' END AS known_status, CASE WHEN start0 % 2 = 0 THEN 'mature' ELSE 'none' END AS known_basis, CASE WHEN start0 % 2 = 0 THEN 'k' || start0 ELSE 'NA' END AS known_id FROM scored")
def j14_with_known(spark, d):
    x = v.scored(spark, d).withColumnRenamed("base_id", "peak_id")
    known = x.where("start0 % 2 = 0").select("peak_id", F.lit("Known-Atypical").alias("known_status"), F.lit("mature").alias("known_basis"), F.concat(F.lit("k"), F.col("start0").cast("string")).alias("known_id"))
    return stages.with_known(x, known).select("candidate_id", "known_status", "known_basis", "known_id")


@query("j15_with_sequence", f"WITH {v.SCORED} SELECT candidate_id, CASE WHEN start0 % 4 <> 0 THEN 'S' || start0 END AS seq, CASE WHEN start0 % 4 = 0 THEN 'MissingCandidateSequence' END AS reject_reason FROM scored")
def j15_with_sequence(spark, d):
    x = v.scored(spark, d).select(F.col("base_id").alias("peak_id"), F.col("pad").alias("best_pad"), "candidate_id", "start0")
    fasta = x.where("start0 % 4 <> 0").select(F.col("candidate_id").alias("id"), F.concat(F.lit("S"), F.col("start0").cast("string")).alias("seq"))
    rows, rejects = stages.with_sequence(x.drop("candidate_id"), fasta)
    return rows.unionByName(rejects, allowMissingColumns=True).select("candidate_id", "seq", "reject_reason")


@query("j16_with_mature", f"WITH {v.SCORED} SELECT candidate_id, CASE WHEN start0 % 3 > 0 THEN CASE WHEN start0 % 3 = 2 THEN '3p' ELSE '5p' END END AS arm, CASE WHEN start0 % 3 = 0 THEN 'MissingMaturePrediction' END AS reject_reason FROM scored")
def j16_with_mature(spark, d):
    x = v.scored(spark, d).select("candidate_id", "start0")
    first = x.where("start0 % 3 > 0").select(F.col("candidate_id").alias("id"), F.lit(1).alias("pos"), F.lit("5p").alias("arm"))
    rows, rejects = stages.with_mature(x, first.unionAll(x.where("start0 % 3 = 2").select("candidate_id", F.lit(2), F.lit("3p"))))
    return rows.unionByName(rejects, allowMissingColumns=True).select("candidate_id", "arm", "reject_reason")


@query("j20_substring_anti", "WITH n AS (SELECT DISTINCT p_name AS seq FROM part WHERE p_partkey % 10 = 0), b AS (SELECT DISTINCT substr(p_name, 2, 1 + p_partkey % 9) AS seq FROM part WHERE p_partkey % 97 = 0) SELECT seq FROM n WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.seq <> '' AND (contains(n.seq, b.seq) OR contains(b.seq, n.seq)))")
def j20_substring_anti(spark, d):
    p = v.load(spark, d, "part")
    b = p.where("p_partkey % 97 = 0").select(F.col("p_name").substr(F.lit(2), (1 + F.col("p_partkey") % 9).cast("int")).alias("seq")).distinct()
    return stages.mutual_substring_anti(p.where("p_partkey % 10 = 0").select(F.col("p_name").alias("seq")).distinct(), b)


@query("j23_backfill", f"WITH {v.SCORED} SELECT candidate_id, CASE WHEN start0 % 3 = 1 THEN 'F' ELSE 'S' END AS seq, CASE WHEN start0 % 3 = 2 THEN NULL ELSE '..' END AS dotbracket FROM scored")
def j23_backfill(spark, d):
    x = v.scored(spark, d).select("candidate_id", "start0")
    three = F.col("start0") % 3
    final = x.select("candidate_id", F.when(three == 1, "F").otherwise("").alias("seq"), F.when(three == 0, "..").alias("dotbracket"))
    struct = x.select("candidate_id", F.lit("S").alias("seq"), F.when(three == 1, "..").when(three == 2, "").alias("dotbracket"))
    return stages.backfill(x.select("candidate_id", F.lit("old").alias("seq"), F.lit("old").alias("dotbracket")), final, struct)


REPEATS = "reps AS (SELECT k_chrom AS c, k_start0 AS s, k_end0 AS e, ['Simple_repeat', 'LINE', '(AT)n', 'LTR'][s % 4 + 1] AS name FROM known)"


def _repeats(spark, d):
    names = F.array(*map(F.lit, ("Simple_repeat", "LINE", "(AT)n", "LTR")))
    return v.known(spark, d).select("k_chrom", "k_start0", "k_end0", F.element_at(names, (F.col("k_start0") % 4 + 1).cast("int")).alias("repeat_class"))


@query("j6_repeat_class", f"WITH {q.PEAKS}, {REPEATS}, h AS (SELECT peak_id, arg_min(name, {{'s': s, 'e': e, 'n': name}}) AS n FROM peaks JOIN reps ON chrom = c AND start0 < e AND s < end0 GROUP BY peak_id) SELECT peak_id, coalesce(n, 'None') AS repeat_class FROM peaks LEFT JOIN h USING (peak_id)")
def j6_repeat_class(spark, d):
    return stages.repeat_class(q._peaks(spark, d), _repeats(spark, d)).select("peak_id", "repeat_class")


@query("j7_p11_repeat_gate", f"""WITH {q.PEAKS}, {REPEATS}, h AS (SELECT peak_id, arg_max(name, {{'s': s, 'e': e, 'n': name}}) AS n, bool_or(contains(lower(name), 'simple') OR contains(lower(name), 'low') OR contains(lower(name), 'satellite') OR contains(lower(name), ')n')) AS simple FROM peaks JOIN reps ON chrom = c AND start0 < e AND s < end0 GROUP BY peak_id)
SELECT peak_id, coalesce(n, 'None') AS repeat_family, CASE WHEN simple THEN 'SimpleRepeat' WHEN n IS NOT NULL AND depth % 2 = 0 AND NOT (depth % 10 / 10 >= 0.9 AND depth % 7 / 7 >= 0.7) THEN 'RepeatStrictFail' END AS reject_reason FROM peaks LEFT JOIN h USING (peak_id)""")
def j7_p11_repeat_gate(spark, d):
    x = stages.repeat_check(q._peaks(spark, d), _repeats(spark, d))
    anchor = F.when(F.col("depth") % 2 == 0, "Multi").otherwise("Unique")
    return x.select("peak_id", "repeat_family", stages.repeat_gate(F.col("has_repeat"), F.col("simple_repeat"), anchor, F.col("depth") % 10 / 10, F.col("depth") % 7 / 7).alias("reject_reason"))


@query("j21_benchmark_near_duplicates", """WITH g AS (SELECT item_id, unnest(list_distinct(list_transform(range(1, length(text) - 4), lambda i: substr(text, i, 6)))) AS m, length(text) AS n FROM benchmark WHERE length(text) >= 6), s AS (SELECT item_id, count(*) AS n FROM g GROUP BY ALL),
d AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, length(text) - 4), lambda i: substr(text, i, 6)))) AS m FROM documents WHERE length(text) >= 6), t AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
hit AS (SELECT doc_id FROM (SELECT doc_id, item_id, count(*) AS c FROM d JOIN g USING (m) GROUP BY ALL) JOIN s USING (item_id) JOIN t USING (doc_id) WHERE c / (s.n + t.n - c) >= 0.4)
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM hit)""")
def j21_benchmark_near_duplicates(spark, d):
    def grams(df, key):
        k = df.where(F.length("text") >= 6).select(key, sq.kmers(F.col("text"), 6).alias("k"))
        return k.select(key, F.size("k").alias(f"n_{key}"), F.explode("k").alias("m"))

    docs = v.spread(v.load(spark, d, "documents").select("doc_id", "text"))
    x = grams(docs, "doc_id").join(grams(v.load(spark, d, "benchmark"), "item_id"), "m")
    c = x.groupBy("doc_id", "item_id", "n_doc_id", "n_item_id").agg(F.count("*").alias("c"))
    hit = c.where("c / (n_doc_id + n_item_id - c) >= 0.4").select("doc_id").distinct()
    return docs.select("doc_id").join(hit, "doc_id", "left_anti")


@query("x9_mature_choice", f"""WITH {v.SEQUENCES}, c AS (SELECT id, seq, (id % 90)::INT AS pad, CASE WHEN id % 7 = 0 THEN 'NA' ELSE (id % 60)::VARCHAR END AS s, CASE WHEN id % 7 = 0 THEN 'NA' ELSE (id % 60 + 22)::VARCHAR END AS e, CASE WHEN id % 5 = 0 THEN 'NA' ELSE (15 + id % 14)::VARCHAR END AS lm FROM sequences),
n AS (SELECT *, coalesce(abs(pad - (try_cast(s AS INT) + try_cast(e AS INT)) / 2) > 20 AND seq <> '' AND pad > 0, false) AS o, least(24, greatest(18, coalesce(try_cast(lm AS INT), 22))) AS n FROM c),
w AS (SELECT *, greatest(0, pad - n // 2) AS a, least(length(seq), pad + n // 2 + n % 2) AS b FROM n)
SELECT id, o AS overridden, CASE WHEN o THEN a::VARCHAR ELSE s END AS m_start, CASE WHEN o THEN b::VARCHAR ELSE e END AS m_end, CASE WHEN o THEN (b - a)::VARCHAR ELSE '22' END AS m_length, CASE WHEN o THEN CASE WHEN a < length(seq) / 2 THEN '5p' ELSE '3p' END ELSE '5p' END AS m_arm, CASE WHEN o THEN '0.0' ELSE '0.7' END AS m_score, CASE WHEN o THEN substr(seq, a + 1, greatest(b - a, 0)) ELSE 'M' END AS m_seq FROM w""")
def x9_mature_choice(spark, d):
    i = F.col("id")
    na = lambda c, n: F.when(i % n == 0, "NA").otherwise(c.cast("string"))
    x = v.sequences(spark, d).select("id", "seq", (i % 90).cast("int").alias("pad"), na(i % 60, 7).alias("start"), na(i % 60 + 22, 7).alias("end"), na(15 + i % 14, 5).alias("len_mode"), F.lit("22").alias("length"), F.lit("5p").alias("arm"), F.lit("0.7").alias("score"), F.lit("M").alias("mature_seq"))
    return labels.mature_choice(x).select("id", "overridden", "m_start", "m_end", "m_length", "m_arm", "m_score", "m_seq")


# Gates, orders and counters.


@query("p14_pseudo_hairpin", q.CORE_SQL + """, g AS (SELECT *, list_reverse_sort(list_transform(regexp_extract_all(struct, '\\.+'), lambda x: length(x))) AS u, list_max(list_transform(regexp_extract_all(struct, '\\(+|\\)+'), lambda x: length(x))) AS stem FROM c)
SELECT id, length(seq) <= 120 AND mfe <= -18 AND p >= 18 AND len(u) BETWEEN 1 AND 9 AND coalesce(stem, 0) >= 10 AND (length(struct) - length(replace(struct, '.', ''))) / length(seq) <= 0.45 AND coalesce(u[2], 0) <= 8 AS passes FROM g""")
def p14_pseudo_hairpin(spark, d):
    return v.folded(spark, d).select("id", st.pseudo_hairpin(F.col("seq"), F.col("struct"), F.col("mfe"), loops=9).alias("passes"))


@query("p16_prefer_lengths", f"WITH {v.SCORED}, h AS (SELECT base_id, start0 AS s, start0 + hp_len AS e, rf_score FROM scored), r AS (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY CASE WHEN e - s BETWEEN 60 AND 220 THEN 0 ELSE 1 END, rf_score DESC, e - s DESC, s) AS rn FROM h) SELECT base_id, s AS start, e AS \"end\", rf_score FROM r WHERE rn = 1")
def p16_prefer_lengths(spark, d):
    x = v.scored(spark, d).select("base_id", F.col("start0").alias("start"), (F.col("start0") + F.col("hp_len")).alias("end"), "rf_score")
    return stages.prefer_lengths(x, "base_id")


@query("a6_pad_rejects", f"WITH {v.SCORED}, x AS (SELECT base_id, pad, start0 % 5 <> 0 AS real FROM scored WHERE pad = 70 OR start0 % 3 <> 0), g AS (SELECT base_id, count(DISTINCT pad) AS n, count(*) FILTER (real) AS m FROM x GROUP BY base_id) SELECT base_id, 'MissingPadVariant' AS reject_reason FROM g WHERE n < 2 UNION ALL SELECT base_id, 'NoNumericRFScore' FROM g WHERE m = 0")
def a6_pad_rejects(spark, d):
    x = v.scored(spark, d).where("pad = 70 OR start0 % 3 <> 0")
    return collapse.pad_rejects(x.withColumn("rf_score", F.when(F.col("start0") % 10 == 0, float("nan")).when(F.col("start0") % 5 != 0, F.col("rf_score"))))


@query("a7_a8_a12_counters", q.LADDER + " SELECT 'final_label' AS counter, final_label AS value, count(*) AS n FROM final GROUP BY ALL UNION ALL SELECT 'repeat_class', rc, count(*) FROM final GROUP BY ALL UNION ALL SELECT 'known_db', known_db, count(*) FROM final GROUP BY ALL")
def a7_a8_a12_counters(spark, d):
    return stages.counters(q._final(spark, d), "final_label", "repeat_class", "known_db")


@query("k6_summary", f"WITH {v.LABELLED} SELECT 'scores.n' AS key, count(*)::VARCHAR AS value FROM labelled UNION ALL SELECT 'scores.positives', count(*) FILTER (label = 1)::VARCHAR FROM labelled UNION ALL SELECT 'docs.n', (SELECT count(*) FROM documents)::VARCHAR")
def k6_summary(spark, d):
    x = v.labelled(spark, d).agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("positives"))
    return stages.summary({"scores": x, "docs": v.load(spark, d, "documents").agg(F.count("*").alias("n"))})


@query("o1_output_order", f"WITH {v.SCORED} SELECT base_id, row_number() OVER (ORDER BY chrom, start0, strand, base_id)::BIGINT AS place FROM (SELECT DISTINCT base_id, chrom, start0, strand FROM scored)")
def o1_output_order(spark, d):
    from ribospark.sources.writers import place_of

    x = v.scored(spark, d).select("base_id", "chrom", F.col("start0").alias("center0"), "strand").distinct()
    return place_of(stages.output_order(x)).select("base_id", "place")


@query("o2_top_novel", q.LADDER + " SELECT peak_id, s FROM final WHERE final_label = 'Novel-High' ORDER BY round(s, 3) DESC, peak_id LIMIT 15")
def o2_top_novel(spark, d):
    return stages.top_novel(q._final(spark, d), 15).select("peak_id", "s")


@query("a13_a19_compare", f"WITH {v.LABELLED}, m AS (SELECT avg(score) FILTER (label = 1) - avg(score) FILTER (label = 0) AS s, avg(doc_id % 50) FILTER (label = 1) - avg(doc_id % 50) FILTER (label = 0) AS k FROM labelled) SELECT 'score' AS metric, round(abs(s), 9) AS distance, abs(s) > 0.05 AS differs FROM m UNION ALL SELECT 'k', round(abs(k), 9), abs(k) > 10 FROM m")
def a13_a19_compare(spark, d):
    x = v.labelled(spark, d).withColumn("k", F.col("doc_id") % 50)
    return stages.compare_means(x.where("label = 1"), x.where("label = 0"), {"score": 0.05, "k": 10}).withColumn("distance", F.round("distance", 9))


@query("a20_a21_limits", q.CORE_SQL + " SELECT 'pairs' AS metric, round_even(quantile_cont(p::DOUBLE, 0.99), 0) AS suggested FROM c UNION ALL SELECT 'loops', round_even(quantile_cont(len(r)::DOUBLE, 0.99), 0) FROM c")
def a20_a21_limits(spark, d):
    x = v.folded(spark, d).select(st.num_pairs(F.col("struct")).alias("pairs"), F.size(st.inner_runs(F.col("struct"))).alias("loops"))
    return stages.suggest_limits(x, ["pairs", "loops"])


@query("v14_known_tables", q.LADDER + " SELECT known_status, count(*) AS n FROM final WHERE known_status IN ('Known-Confirmed', 'Known-Atypical') GROUP BY ALL")
def v14_known_tables(spark, d):
    from ribospark.operators.labels import late_labels

    x = late_labels(q._peaks(spark, d), v.known(spark, d))
    return x.where(F.col("known_status").isin("Known-Confirmed", "Known-Atypical")).groupBy("known_status").agg(F.count("*").alias("n"))


@query("v7_scan_report", f"WITH {v.LABELLED} SELECT count(*) AS n, round(median(score), 9) AS median, median(score) NOT BETWEEN 0.1 AND 0.5 AS off_band, count(*) FILTER (score > 0.9) AS above_09, count(*) FILTER (score >= 0.6) AS above_q95, count(*) FILTER (score >= 0.6) / count(*) AS share_q95 FROM labelled")
def v7_scan_report(spark, d):
    return stats.scan_report(v.labelled(spark, d), 0.6).withColumn("median", F.round("median", 9))


# Models and mature arms: checked in tests against plain Python, or by rows only.


@query("m3_featurize")
def m3_featurize(spark, d):
    return ft.featurize(v.folded(spark, d))


FEATURES = ("gc_frac", "paired_frac", "mfe_per_nt", "num_loops")


def _fold(df):
    return v.mirror_fold(df)


def _simple_score(df):
    """A stand-in for a trained model: the paired share."""
    return df.withColumn("rf_score", F.round(2.0 * st.num_pairs(F.col("struct")) / sq.length1(F.col("seq")), 9))


@query("m6_x8_predict")
def m6_x8_predict(spark, d):
    s = F.translate(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""), v.FROM, v.TO)
    x = v.spread(v.load(spark, d, "documents")).select(F.col("doc_id").alias("input_id"), s.alias("seq")).where("seq <> ''")
    return models.predict_sequences(x, _fold, _simple_score, step=60)


@query("m7_m5_forest")
def m7_m5_forest(spark, d):
    x = v.folded(spark, d)
    c = ft.core(F.col("seq"), F.col("struct"), F.col("mfe"))
    x = x.select("id", *[c[k].alias(k) for k in FEATURES], (c["gc_frac"] > 0.5).cast("int").alias("label"))
    model = models.train_forest(x.where("id % 10 < 5"), FEATURES, trees=20, depth=4)
    return models.score(x, model, FEATURES).select("id", "rf_score", "pred_label")


@query("f24_f26_duplexes")
def f24_f26_duplexes(spark, d):
    return mature.duplex_candidates(v.folded(spark, d)).drop("cand")


@query("w20_v20_predict_mature")
def w20_v20_predict_mature(spark, d):
    x = v.folded(spark, d)
    c = mature.duplex_candidates(x).withColumn("score", F.col("feat_paired_frac") - F.col("feat_3p_tail_abs2") / 100)
    return mature.predict(x, c)


@query("w21_best_windows")
def w21_best_windows(spark, d):
    return mature.best_windows(v.folded(spark, d))


# Negative sets and peaks of the older and the optional path.


@query("p17_a28_decoys", f"""WITH {v.SEQUENCES}, p AS (SELECT DISTINCT replace(seq, 'U', 'T') AS t FROM sequences WHERE id % 7 = 0),
r AS (SELECT CASE id % 5 WHEN 0 THEN 'tRNA|' WHEN 1 THEN 'SNORNA-' WHEN 2 THEN 'x_rRNA_' WHEN 3 THEN 'snRNA' ELSE 'y' END || id AS id, seq, replace(seq, 'U', 'T') AS t FROM sequences),
s AS (SELECT *, CASE WHEN contains(lower(id), 'trna') THEN 'tRNA' WHEN contains(lower(id), 'snorna') THEN 'snoRNA' WHEN contains(lower(id), 'rrna') THEN 'rRNA' ELSE 'unknown' END AS source FROM r)
SELECT id, seq, source, length(seq) AS len, 'N3|source=' || source || '|id=' || id || '|len=' || length(seq) AS neg_id,
  CASE WHEN length(seq) NOT BETWEEN 50 AND 200 THEN 'len' WHEN t IN (SELECT t FROM p) THEN 'dup' WHEN source = 'unknown' THEN 'source' END AS reject_reason FROM s""")
def p17_a28_decoys(spark, d):
    s = v.sequences(spark, d)
    form = F.element_at(F.array(*[F.lit(x) for x in ("tRNA|", "SNORNA-", "x_rRNA_", "snRNA", "y")]), (F.col("id") % 5 + 1).cast("int"))
    return negatives.decoys(s.select(F.concat(form, F.col("id").cast("string")).alias("id"), "seq"), s.where("id % 7 = 0"), ("tRNA", "snoRNA", "rRNA"))


@query("f30_p18_shuffled_negatives")
def f30_p18_shuffled_negatives(spark, d):
    return negatives.shuffled_negatives(v.sequences(spark, d), _fold, per_seq=2)


@query("f31_mono_shuffles")
def f31_mono_shuffles(spark, d):
    return negatives.mono_shuffles(v.sequences(spark, d), 2, tries=2).select("id", "i", "shuffled")


@query("p30_v17_negatives_report", """WITH t AS (SELECT p_partkey AS k, p_partkey % 19 AS m, substr(repeat('ACGGU', 20), 1, p_partkey % 30 + 1) AS seq FROM part),
n AS (SELECT *, CASE k % 4 WHEN 0 THEN 'N1|orig=h' || k || '|gc=0.5|mfe=-' || m || '.7|seed=42' WHEN 1 THEN 'N2|chr' || m || ':' || k || '-' || (k + 90) || '|mfe_nt=-0.3' WHEN 2 THEN 'N3|source=tRNA|id=d' || k || '|len=9' ELSE 'other|id=' || k END AS id FROM t),
e AS (SELECT *, (length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / length(seq) AS gc,
  CASE k % 4 WHEN 0 THEN ('-' || m || '.7')::DOUBLE WHEN 1 THEN -0.3::DOUBLE * length(seq) END AS mfe, CASE k % 4 WHEN 0 THEN ('-' || m || '.7')::DOUBLE / length(seq) WHEN 1 THEN -0.3::DOUBLE END AS per FROM n)
SELECT ['N1_composition', 'N2_scan_matched', 'N3_decoy', 'unknown'][k % 4 + 1] AS bucket, id, CASE k % 4 WHEN 0 THEN 'h' || k WHEN 2 THEN 'd' || k ELSE 'NA' END AS source_id,
  CASE WHEN k % 4 = 1 THEN 'chr' || m ELSE 'NA' END AS chr, CASE WHEN k % 4 = 1 THEN k::VARCHAR ELSE 'NA' END AS start, CASE WHEN k % 4 = 1 THEN (k + 90)::VARCHAR ELSE 'NA' END AS "end",
  length(seq) AS len, printf('%.3f', gc) AS gc, coalesce(printf('%.1f', mfe), 'NA') AS mfe, coalesce(printf('%.3f', per), 'NA') AS mfe_per_nt, 'NA' AS paired_frac,
  ['dinuc_shuffle', 'scan_extracted', 'mirbase_decoy', ''][k % 4 + 1] AS notes FROM e""")
def p30_v17_negatives_report(spark, d):
    text = lambda c: c.cast("string")
    k, m = F.col("p_partkey"), F.col("p_partkey") % 19
    forms = [F.concat(F.lit("N1|orig=h"), text(k), F.lit("|gc=0.5|mfe=-"), text(m), F.lit(".7|seed=42")), F.concat(F.lit("N2|chr"), text(m), F.lit(":"), text(k), F.lit("-"), text(k + 90), F.lit("|mfe_nt=-0.3"))]
    forms += [F.concat(F.lit("N3|source=tRNA|id=d"), text(k), F.lit("|len=9")), F.concat(F.lit("other|id="), text(k))]
    seq = F.lit("ACGGU" * 20).substr(F.lit(1), (k % 30 + 1).cast("int"))
    return negatives.negatives_report(v.load(spark, d, "part").select(F.element_at(F.array(*forms), (k % 4 + 1).cast("int")).alias("neg_id"), seq.alias("seq")))


@query("o10_scan_background", f"WITH {v.LABELLED}, c AS (SELECT count(*) AS n FROM labelled WHERE label = 0) SELECT 1.0 AS sample_weight, n FROM c WHERE n > 0 UNION ALL SELECT 0.2, least(500, floor(0.05::DOUBLE / 0.95::DOUBLE * n)::BIGINT) FROM c WHERE floor(0.05::DOUBLE / 0.95::DOUBLE * n) > 0")
def o10_scan_background(spark, d):
    x = v.labelled(spark, d)
    out = negatives.inject_background(x.where("label = 0"), x.where("label = 1"), "doc_id")
    return out.groupBy("sample_weight").agg(F.count("*").alias("n"))


@query("w15_genome_windows", f"WITH {GENOME}, w AS (SELECT chrom, s, unnest(range(0, length(s) - 59, 30)) AS start0 FROM genome) SELECT chrom, start0, start0 + 60 AS end0, substr(s, start0 + 1, 60) AS seq FROM w")
def w15_genome_windows(spark, d):
    letters = F.translate(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""), v.FROM, v.TO)
    return negatives.genome_windows(v.spread(v.load(spark, d, "documents")).select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id"), letters.alias("seq")), 60, 30)


@query("w11_legacy_merge", q.BASES_SQL + """, o AS (SELECT chrom, strand, island_start, list(pos ORDER BY y DESC, pos) AS ps FROM pk GROUP BY ALL)
SELECT chrom, strand, island_start, unnest(list_reduce(list_prepend([]::BIGINT[], list_transform(ps, lambda p: [p])), lambda a, x: CASE WHEN len(list_filter(a, lambda q: abs(q - x[1]) < 8)) > 0 THEN a ELSE list_concat(a, x) END)) AS pos FROM o""")
def w11_legacy_merge(spark, d):
    return islands.legacy_merge(islands.peaks(q._signal(spark, d)))


@query("w9_prominent_peaks")
def w9_prominent_peaks(spark, d):
    return islands.peaks_by_prominence(q._signal(spark, d), width=(1, 60)).withColumn("y", F.round("y", 6))
