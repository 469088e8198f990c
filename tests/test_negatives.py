from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ribospark.functions import sequence as sq
from ribospark.operators import islands, negatives
from ribospark.plans import views
from ribospark.sources import readers


def pairs(s):
    return Counter(zip(s, s[1:]))


def test_walks_use_the_pairs_of_their_sequence(spark):
    rng = np.random.default_rng(1)
    seqs = ["", "a", "ac", "aaaa", *("".join(rng.choice(list("acgt"), n)) for n in rng.integers(3, 90, 60))]
    df = spark.createDataFrame(list(enumerate([*seqs, None])), "id int, seq string")
    make = lambda: {r.id: r.x for r in df.select("id", negatives.dinucleotide_shuffle(F.col("seq"), F.lit(7)).alias("x")).collect()}
    got = make()
    assert got == make() and got[len(seqs)] is None
    changed = 0
    for i, s in enumerate(seqs):
        u, x = s.upper(), got[i]
        assert x[:1] == u[:1] and not pairs(x) - pairs(u)
        left = pairs(u) - pairs(x)
        assert len(u) <= 2 or not any(a == x[-1] for a, _ in left)
        assert left.total() == len(u) - len(x)
        changed += x != u
    assert changed > 40


def test_mono_shuffles_are_different(spark):
    df = spark.createDataFrame([("ACGUACGU",), ("AAAA",), ("",)], "seq string")
    got = {}
    for r in negatives.mono_shuffles(df, 3).collect():
        got.setdefault(r.seq, []).append(r.shuffled)
    assert {k: len(x) for k, x in got.items()} == {"ACGUACGU": 3, "AAAA": 1, "": 1}
    assert all(sorted(x) == sorted(k) and len(set(v)) == len(v) for k, v in got.items() for x in v)


def test_shuffled_negatives_in_order(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "".join(rng.choice(list("ACGU"), int(n)))) for i, n in enumerate(rng.integers(3, 12, 40))]
    rows += [(40 + i, s) for i, s in rows[:5]]
    df = spark.createDataFrame(rows, "id int, seq string")
    out = negatives.shuffled_negatives(df, views.mirror_fold, per_seq=6)
    got = {(r["id"], r["try"]): r for r in out.collect()}
    assert len(got) == 6 * len(rows)
    folds = {r.seq: (r.mfe, r.paired) for r in views.mirror_fold(df.select(sq.to_dna(F.col("seq")).alias("seq"))).select("seq", "mfe", F.lit(0.0).alias("paired")).collect()}
    share = lambda s: (s.count("G") + s.count("C")) / max(1, len(s))
    own = {r["id"]: r for r in views.mirror_fold(df.select("id", sq.to_dna(F.col("seq")).alias("seq"))).collect()}
    part = lambda st: 2 * st.count("(") / max(1, len(st))
    seen = {s.replace("U", "T") for _, s in rows}
    assert set(folds) == seen
    for k in sorted(got):
        r, o = got[k], own[k[0]]
        dna = r.seq.replace("U", "T")
        if dna in seen:
            want = "dup"
        elif abs(share(dna) - share(o.seq)) > 0.02:
            want = "gc"
        elif r.mfe < o.mfe - 2:
            want = "mfe"
        elif r.paired > part(o.struct) + 0.05:
            want = "paired"
        else:
            want = None
            seen.add(dna)
        assert r.reject_reason == want, (k, r)
        assert r.neg_id == f"N1|orig={k[0]}|gc={share(dna):.3f}|mfe={r.mfe + 0.0:.1f}|seed=42"
    counts = {r.reject_reason: r.n for r in negatives.reject_counts(out).collect()}
    assert counts == Counter(r.reject_reason or "accepted" for r in got.values()) and len(counts) > 2


def test_fixed_rounds_like_binary_fractions(spark):
    xs = [0.0625, 0.1875, 0.5, 1 / 3, -2.25, -2.35, 12.0, 0.3125, 7 / 11]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [tuple(r) for r in df.select(negatives.fixed(F.col("x"), 3), negatives.fixed(F.col("x"), 1)).collect()] == [(f"{x:.3f}", f"{x:.1f}") for x in xs]


def test_report_of_ids(spark):
    rows = [("N2|chr1:5-9|mfe_nt=-0.5", "ACGU"), ("N2|chr1:5:9|x", "A"), ("N1|orig=a|mfe=bad", ""), ("N1", "G")]
    got = [tuple(r) for r in negatives.negatives_report(spark.createDataFrame(rows, "neg_id string, seq string")).collect()]
    assert got[0] == ("N2_scan_matched", rows[0][0], "NA", "chr1", "5", "9", 4, "0.500", "-2.0", "-0.500", "NA", "scan_extracted")
    assert got[1][3:6] == ("NA", "NA", "NA") and got[2][2:10] == ("a", "NA", "NA", "NA", 0, "0.000", "NA", "NA")
    assert got[3][0] == "N1_composition" and got[3][2] == "NA"


def test_windows_and_buckets(spark):
    g = spark.createDataFrame([("a", "ACGU" * 5), ("b", "AC"), ("c", "ACnU" * 5)], "id string, seq string")
    w = negatives.genome_windows(g, 8, 5)
    assert sorted((r.chrom, r.start0, r.end0, r.seq) for r in w.collect()) == [("a", i, i + 8, ("ACGU" * 5)[i : i + 8]) for i in (0, 5, 10)]
    x = spark.createDataFrame([(f"n{i}",) for i in range(30)], "neg_id string")
    one = [r.neg_id for r in negatives.union_buckets({"N1": x.where("neg_id < 'n2'"), "N2": x.where("neg_id >= 'n2'")}).collect()]
    assert sorted(one) == sorted(f"n{i}" for i in range(30)) and one != sorted(one)
    assert one == [r.neg_id for r in negatives.union_buckets({"N1": x}).collect()]


def plain_prominence(y, p):
    sides = []
    for step in (-1, 1):
        i, low, base = p, y[p], p
        while 0 <= i < len(y) and y[i] <= y[p]:
            if y[i] < low:
                low, base = y[i], i
            i += step
        sides.append((low, base))
    return y[p] - max(sides[0][0], sides[1][0]), sides[0][1], sides[1][1]


def plain_peaks(y, distance, least, width):
    tops, i = [], 1
    while i < len(y) - 1:
        j = i
        while j < len(y) - 1 and y[j + 1] == y[i]:
            j += 1
        if j < len(y) - 1 and y[i - 1] < y[i] > y[j + 1]:
            tops.append((i + j) // 2)
        i = j + 1
    kept = []
    for p in sorted(tops, key=lambda p: (-y[p], -p)):
        if all(abs(p - k) >= distance for k in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        prom, lo, hi = plain_prominence(y, p)
        if prom < least:
            continue
        if width:
            h, ends = y[p] - prom / 2, []
            for step, stop in ((-1, lo), (1, hi)):
                i = p
                while i != stop and y[i] > h:
                    i += step
                ends.append(i - step * (h - y[i]) / (y[i - step] - y[i]) if y[i] < h else i)
            if not width[0] <= ends[1] - ends[0] <= width[1]:
                continue
        out.append(p)
    return out


def test_prominent_peaks_against_plain_python():
    rng = np.random.default_rng(3)
    for n in range(1, 120):
        y = rng.integers(0, 9, n).astype(float)
        for distance, least, width in ((1, 0.0, None), (4, 2.0, None), (3, 1.0, (1, 3)), (6, None, None)):
            got = islands.prominent_peaks(y, distance, least, width).tolist()
            assert got == plain_peaks(y.tolist(), distance, max(1.0, 0.05 * y.max()) if least is None else least, width)


def test_gff3_kinds(spark, tmp_path):
    rows = [("miRNA", "ID=a;Name=b"), ("stem_loop", "Name=x"), ("gene", "so_term=MATURE_x"), ("gene", "Ontology_term=a hairpin"), ("gene", "Name=let-7-5P"), ("gene", "Alias=q"), ("gene", "")]
    lines = ["##gff", *("\t".join(("c1", "s", t, str(10 * i + 1), str(10 * i + 9), ".", "+" if i % 2 else "?", ".", a)) for i, (t, a) in enumerate(rows)), "c1\ts\tgene\tx\t9\t.\t+\t.\tID=z"]
    (tmp_path / "x.gff3").write_text("\n".join(lines) + "\n")
    got = sorted(tuple(r) for r in readers.read_gff3_any(spark, str(tmp_path / "x.gff3"), "db").collect())
    assert [r[5] for r in got] == ["mature", "precursor", "mature", "precursor", "mature", "other", "other"]
    assert got[0] == ("c1", 0, 9, ".", "db", "mature", "a", "b") and got[1][3] == "+"
    assert [r[6] for r in got[2:]] == ["db:c1:20-29:.", "db:c1:30-39:+", "let-7-5P", "q", "db:c1:60-69:."] and got[4][7] == "let-7-5P" and got[5][7] == "q"
