"""Stage plumbing: keys and ids, projections between stages, and joins whose misses are audited rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ribospark.functions.sequence import low_complexity, revcomp
from ribospark.operators.collapse import best_row
from ribospark.operators.intervals import overlap_join
from ribospark.sources.readers import fetch


def _text(df: DataFrame, name: str) -> Column:
    """A column as text, NA where the table lacks it or holds nothing."""
    return F.coalesce(F.col(name).cast("string"), F.lit("NA")) if name in df.columns else F.lit("NA")


# Reads and windows.


def trim_adapter(reads: DataFrame, adapter: str, shortest: int = 18, longest: int = 30, untrimmed: bool = True) -> DataFrame:
    """reads (seq) cut before the adapter's first exact place, then by length; without untrimmed, reads lacking it go."""
    at = F.instr("seq", adapter)
    out = reads if untrimmed else reads.where(at > 0)
    return out.withColumn("seq", F.when(at > 0, F.expr("seq").substr(F.lit(1), at - 1)).otherwise(F.col("seq"))).where(F.length("seq").between(shortest, longest))


def n_free(seq: Column) -> Column:
    return ~F.contains(F.upper(seq), F.lit("N"))


def window_order(windows: DataFrame, seed: int = 42, by: Sequence[str] = ("chrom", "start0")) -> DataFrame:
    """windows with a seeded order key, the same on every run; sorting by it shuffles them."""
    return windows.withColumn("order_key", F.xxhash64(*by, F.lit(seed)))


def random_length(seed: int, *by: str, shortest: int = 60, longest: int = 100) -> Column:
    """A window length between the bounds from a hash of the row's place."""
    return (F.lit(shortest) + F.pmod(F.xxhash64(*by, F.lit(seed)), F.lit(longest - shortest + 1))).cast("int")


# Ids and keys.


def peak_key(df: DataFrame) -> Column:
    """peak_id: with the id where there is one, else sample|chrom|strand|center|anchor."""
    center = "peak_center0" if "peak_center0" in df.columns else "peak_center"
    chrom, strand, c = _text(df, "chrom"), _text(df, "strand"), _text(df, center)
    full = F.concat_ws("|", _text(df, "sample_id"), chrom, strand, c, _text(df, "anchor_type"))
    out = F.when((chrom != "NA") & (strand != "NA") & (c != "NA"), full).otherwise(F.concat_ws("|", chrom, strand, c))
    if "peak_id" in df.columns:
        out = F.when(F.length(F.col("peak_id").cast("string")) > 0, F.concat(F.lit("peak_id:"), F.col("peak_id").cast("string"))).otherwise(out)
    return out


def synth_peak_id(df: DataFrame) -> Column:
    made = F.concat_ws("|", *[_text(df, c) for c in ("sample_id", "island_id", "peak_center0", "anchor_type")])
    return F.coalesce(F.nullif(F.col("peak_id").cast("string"), F.lit("")), made) if "peak_id" in df.columns else made


def split_candidate_id(c: Column) -> dict[str, Column]:
    """base_id and pad of an id that ends in |pad and digits; the id itself and null otherwise."""
    fits = c.rlike(r"\|pad\d+$")
    return {"base_id": F.when(fits, F.regexp_replace(c, r"\|pad\d+$", "")).otherwise(c), "pad": F.regexp_extract(c, r"\|pad(\d+)$", 1).try_cast("int")}


def header_coords(c: Column) -> Column:
    """struct(chrom, start, end) from chrX:1-2, else chrX_1_2, in a header; null without either."""
    parts = [r"(chr\w+):(\d+)-(\d+)", r"(chr\w+)_(\d+)_(\d+)"]
    of = lambda p: F.struct(F.regexp_extract(c, p, 1).alias("chrom"), F.regexp_extract(c, p, 2).try_cast("long").alias("start"), F.regexp_extract(c, p, 3).try_cast("long").alias("end"))
    return F.when(c.rlike(parts[0]), of(parts[0])).when(c.rlike(parts[1]), of(parts[1]))


def bucket_of(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, r"^(N[123])[|_]", 1), F.lit("")), F.lit("unknown"))


def parent_id(c: Column) -> Column:
    """First word without an arm suffix, then without a mature, star or loop suffix."""
    return F.regexp_replace(F.regexp_replace(F.split(F.trim(c), r"\s+")[0], r"(?i)-(5p|3p)$", ""), r"(?i)-(mature|star|loop)$", "")


def base_hairpin_id(c: Column) -> Column:
    """First word without asterisks and without its last underscore part."""
    return F.regexp_replace(F.replace(F.split(F.trim(c), r"\s+")[0], F.lit("*"), F.lit("")), r"_[^_]*$", "")


def species_filter(df: DataFrame, species: str, id_col: str = "id") -> DataFrame:
    return df.where(F.col(id_col).startswith(species))


def negative_index(df: DataFrame) -> DataFrame:
    """bucket (text before the first pipe), id, length and provenance of tagged sequences (id, seq)."""
    return df.select(F.split_part("id", F.lit("|"), F.lit(1)).alias("bucket"), "id", F.length("seq").alias("len"), F.substr("id", F.length(F.split_part("id", F.lit("|"), F.lit(1))) + 2).alias("provenance"))


# Coordinates.


def genomic(strand: Column, start0: Column, end0: Column, local_start: Column, local_end: Column) -> dict[str, Column]:
    """A region's local interval on the genome; every strand but + counts from the end."""
    plus = strand == "+"
    return {"hp_start0": F.when(plus, start0 + local_start).otherwise(end0 - local_end), "hp_end0": F.when(plus, start0 + local_end).otherwise(end0 - local_start)}


def query_interval(df: DataFrame) -> dict[str, Column]:
    """q_start0, q_end0 and q_strand: the hairpin's interval, else the best one, else the centre with its pad."""
    pairs = [(a, b) for a, b in (("best_hp_start0", "best_hp_end0"), ("best_start0", "best_end0")) if a in df.columns and b in df.columns]
    num = lambda c: F.col(c).cast("string").try_cast("long")
    center, pad = num("peak_center0"), num("best_pad") if "best_pad" in df.columns else F.lit(70)
    good = lambda a, b: F.coalesce(num(b) > num(a), F.lit(False))
    s, e = F.greatest(F.lit(0), center - F.coalesce(pad, F.lit(70))), center + F.coalesce(pad, F.lit(70)) + 1
    for a, b in reversed(pairs):
        s, e = F.when(good(a, b), num(a)).otherwise(s), F.when(good(a, b), num(b)).otherwise(e)
    return {"q_start0": s, "q_end0": e, "q_strand": F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(".")}


def prefer_lengths(hits: DataFrame, key: str, max_hairpin: int = 120) -> DataFrame:
    """Per key the best hit (key, start, end, rf_score) of 60 to max(max_hairpin, 220) bases, or of all where none is; by score, then length."""
    n = F.col("end") - F.col("start")
    fits = n.between(60, max(max_hairpin, 220))
    score = F.coalesce(F.when(~F.isnan("rf_score"), F.col("rf_score")), F.lit(float("-inf")))
    return best_row(hits, [key], [-fits.cast("int"), -score, -n, F.col("start")])


# Joins between stages.


def drop_confirmed(candidates: DataFrame, early: DataFrame) -> DataFrame:
    """Candidates whose peak is not confirmed as known."""
    skip = early.where("known_early_status = 'Known-Confirmed'").select(peak_key(early).alias("__key")).distinct()
    return candidates.join(skip, peak_key(candidates) == F.col("__key"), "left_anti")


def keep_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return rows.join(ids.select(key), key, "left_semi")


def drop_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ids; rows without a key stay (blocklist reads, set difference)."""
    return rows.join(ids.select(key), key, "left_anti")


def complete_join(meta: DataFrame, seqs: DataFrame, key: str, named: int = 25) -> DataFrame:
    """meta with seqs' columns, or a ValueError that names the first ids without a sequence."""
    missing = meta.join(seqs.select(key), key, "left_anti").select(key).orderBy(key).limit(named)
    lost = [str(r[0]) for r in missing.collect()]
    if lost:
        raise ValueError(f"no sequence for: {', '.join(lost)}")
    return meta.join(seqs, key)


def with_known(scored: DataFrame, known: DataFrame) -> DataFrame:
    """scored with known_status, known_basis and known_id by peak_id: Unknown, none, NA where there is no row."""
    fill = {"known_status": "Unknown", "known_basis": "none", "known_id": "NA"}
    k = best_row(known.select("peak_id", *fill), ["peak_id"], [F.col("known_status")])
    x = scored.drop(*fill).join(k, "peak_id", "left")
    return x.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in fill.items()})


def with_sequence(finalists: DataFrame, fasta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with candidate_id and seq, rejects) of finalists (peak_id, best_pad) against fasta (id, seq)."""
    cid = F.concat(F.col("peak_id"), F.lit("|pad"), F.col("best_pad").cast("string"))
    x = finalists.withColumn("candidate_id", cid).join(fasta.select(F.col("id").alias("candidate_id"), "seq"), "candidate_id", "left")
    return x.where("seq IS NOT NULL"), x.where("seq IS NULL").drop("seq").withColumn("reject_reason", F.lit("MissingCandidateSequence"))


def strict_labels(finalists: DataFrame, labels: Sequence[str] = ("Novel-High", "Known-Atypical")) -> DataFrame:
    return finalists.where(F.col("final_label").isin(list(labels)))


def with_mature(struct: DataFrame, mature: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the mature columns, rejects) by candidate_id; of several mature rows of an id (pos) the last counts."""
    cols = [c for c in ("arm", "start", "end", "length", "score", "mature_seq") if c in mature.columns]
    last = best_row(mature.select(F.col("id").alias("candidate_id"), "pos", *cols), ["candidate_id"], [-F.col("pos")]).drop("pos").withColumn("__hit", F.lit(True))
    x = struct.join(last, "candidate_id", "left")
    return x.where("__hit").drop("__hit"), x.where("__hit IS NULL").drop("__hit", *cols).withColumn("reject_reason", F.lit("MissingMaturePrediction"))


def mutual_substring_anti(a: DataFrame, b: DataFrame, k: int = 6) -> DataFrame:
    """a's rows (seq) that neither contain nor lie in a seq of b.

    The contained string's head of up to k letters is a gram of the other: an equi-join on grams finds the pairs.
    """
    grams = lambda s: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(k)), lambda n: F.when(F.length(s) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substring(s, i, n))).otherwise(F.array().cast("array<string>")))))
    x, y = a.select(F.col("seq").alias("x")).where("x <> ''").distinct(), b.select(F.col("seq").alias("y")).where("y <> ''").distinct()
    head = lambda c: F.substring(c, 1, k).alias("g")
    inside = x.select("x", head("x")).join(y.select("y", F.explode(grams(F.col("y"))).alias("g")), "g").where(F.contains("y", "x"))
    around = x.select("x", F.explode(grams(F.col("x"))).alias("g")).join(y.select("y", head("y")), "g").where(F.contains("x", "y"))
    hit = inside.select("x").unionAll(around.select("x")).distinct()
    return a.join(hit.withColumnRenamed("x", "seq"), "seq", "left_anti")


def backfill(report: DataFrame, final: DataFrame, struct: DataFrame, key: str = "candidate_id", cols: Sequence[str] = ("seq", "dotbracket")) -> DataFrame:
    """report with cols from final's rows, from struct's where those are missing or empty."""
    pick = lambda df, p: df.select(key, *[F.nullif(F.col(c), F.lit("")).alias(p + c) for c in cols])
    x = report.drop(*cols).join(pick(final, "__f"), key, "left").join(pick(struct, "__s"), key, "left")
    out = x.withColumns({c: F.coalesce("__f" + c, "__s" + c) for c in cols})
    return out.drop(*["__f" + c for c in cols], *["__s" + c for c in cols])


def repeat_class(windows: DataFrame, repeats: DataFrame) -> DataFrame:
    """windows (chrom, start0, end0) with repeat_class of the first repeat in genome order that they overlap, or None as text."""
    pairs = overlap_join(windows.select("chrom", "start0", "end0").distinct(), repeats)
    first = pairs.groupBy("chrom", "start0", "end0").agg(F.min(F.struct("k_start0", "k_end0", "repeat_class")).alias("b"))
    hit = first.select("chrom", "start0", "end0", F.col("b.repeat_class").alias("repeat_class"))
    return windows.join(hit, ["chrom", "start0", "end0"], "left").withColumn("repeat_class", F.coalesce("repeat_class", F.lit("None")))


def repeat_check(windows: DataFrame, repeats: DataFrame) -> DataFrame:
    """windows with has_repeat, simple_repeat (any name of a simple kind) and repeat_family (the last name in genome order)."""
    low = F.lower("repeat_class")
    simple = F.contains(low, F.lit("simple")) | F.contains(low, F.lit("low")) | F.contains(low, F.lit("satellite")) | F.contains(low, F.lit(")n"))
    pairs = overlap_join(windows.select("chrom", "start0", "end0").distinct(), repeats)
    g = pairs.groupBy("chrom", "start0", "end0").agg(F.bool_or(simple).alias("simple_repeat"), F.max(F.struct("k_start0", "k_end0", "repeat_class")).alias("b"))
    hit = g.select("chrom", "start0", "end0", F.lit(True).alias("has_repeat"), "simple_repeat", F.col("b.repeat_class").alias("repeat_family"))
    x = windows.join(hit, ["chrom", "start0", "end0"], "left")
    return x.withColumns({"has_repeat": F.coalesce("has_repeat", F.lit(False)), "simple_repeat": F.coalesce("simple_repeat", F.lit(False)), "repeat_family": F.coalesce("repeat_family", F.lit("None"))})


def repeat_gate(has: Column, simple: Column, anchor: Column, prec5p: Column, dominance: Column) -> Column:
    """Reject reason of the legacy repeat gate, or null."""
    strict = has & (anchor == "Multi") & ~((prec5p >= 0.90) & (dominance >= 0.70))
    return F.when(has & simple, "SimpleRepeat").when(strict, "RepeatStrictFail")


def excise(peaks: DataFrame, chunks: DataFrame, pads: Sequence[int] = (70, 100), size: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """(candidates, rejects) around each peak (peak_key, chrom, strand, center0): both pads, cut from the genome, reversed on -."""
    x = peaks.withColumn("pad", F.explode(F.array(*map(F.lit, pads))))
    x = x.withColumns({"start0": F.greatest(F.lit(0), F.col("center0") - F.col("pad")), "end0": F.col("center0") + F.col("pad") + 1, "candidate_id": F.concat(F.col("peak_key"), F.lit("|pad"), F.col("pad").cast("string"))})
    x = fetch(x, chunks, size).withColumn("seq", F.when(F.col("strand") == "-", revcomp(F.col("fetched"))).otherwise(F.col("fetched"))).drop("fetched")
    x = x.withColumn("reject_reason", F.when(F.col("seq") == "", "FetchFailed").when(low_complexity(F.col("seq")), "LowComplexity"))
    return x.where("reject_reason IS NULL").drop("reject_reason"), x.where("reject_reason IS NOT NULL").drop("seq")


def rescue_multi(multi: DataFrame, unique: DataFrame, signal: DataFrame, near: int = 25, half: int = 5) -> DataFrame:
    """multi's peaks (chrom, strand, island_start, pos) without those that have a unique peak within near and unique coverage (u) within half."""
    key = ["chrom", "strand", "island_start"]
    by = unique.groupBy(*key).agg(F.collect_set("pos").alias("us"))
    x = multi.join(by, key, "left").withColumn("close", F.coalesce(F.exists("us", lambda c: F.abs(c - F.col("pos")) <= near), F.lit(False)))
    at = x.where("close").select(*key, "pos", F.explode(F.sequence(F.col("pos") - half, F.col("pos") + half)).alias("p"))
    covered = at.join(signal.select(*key, F.col("pos").alias("p"), "u"), [*key, "p"]).groupBy(*key, "pos").agg(F.sum("u").alias("n")).where("n > 0")
    return x.drop("us", "close").join(covered.drop("n"), [*key, "pos"], "left_anti")


# Orders and counters.


def output_order(peaks: DataFrame) -> DataFrame:
    return peaks.orderBy("chrom", "center0", "strand", "base_id")


def top_novel(final: DataFrame, k: int, score: str = "s", id_col: str = "peak_id") -> DataFrame:
    """The k best Novel-High rows by score to three places; ties go to the least id."""
    return final.where("final_label = 'Novel-High'").withColumn("shown", F.round(score, 3)).orderBy(F.desc("shown"), id_col).limit(max(k, 0))


def counters(df: DataFrame, *cols: str) -> DataFrame:
    """(counter, value, n): how often each value of each column occurs, in one pass."""
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).cast("string").alias("value")) for c in cols])).alias("c")
    return df.select(one).groupBy("c.counter", "c.value").agg(F.count("*").alias("n"))


def summary(values: dict[str, DataFrame]) -> DataFrame:
    """Key and value rows of one-row frames: keys are the frames' names and columns."""
    out = None
    for name, df in values.items():
        rows = df.select(F.explode(F.array(*[F.struct(F.lit(f"{name}.{c}").alias("key"), F.col(c).cast("string").alias("value")) for c in df.columns])).alias("r")).select("r.*")
        out = rows if out is None else out.unionAll(rows)
    return out


def compare_means(a: DataFrame, b: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Per metric the distance of both tables' means and whether it is above its limit; two aggregates of one row each."""
    rows = lambda df, n: df.agg(*[F.avg(c).alias(c) for c in limits]).select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias(n)) for c in limits])).alias("r")).select("r.*")
    limit = F.coalesce(*[F.when(F.col("metric") == c, F.lit(float(v))) for c, v in limits.items()])
    d = F.abs(F.col("__a") - F.col("__b"))
    return rows(a, "__a").join(rows(b, "__b"), "metric").select("metric", d.alias("distance"), (d > limit).alias("differs"))


def suggest_limits(df: DataFrame, metrics: Sequence[str], share: float = 0.99) -> DataFrame:
    """Per metric the given quantile, rounded half to even: a bound that keeps that share."""
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in metrics])).alias("m")
    return df.select(one).groupBy("m.metric").agg(F.bround(F.percentile("m.v", share), 0).alias("suggested"))
