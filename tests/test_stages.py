import itertools
import random

import pytest
from pyspark.sql import functions as F

from ribospark.functions import features as ft
from ribospark.functions import structure as st
from ribospark.operators import collapse, labels, mature, models, stages
from ribospark.sources import readers


def random_folds(n=60, seed=4):
    rng = random.Random(seed)
    out = [("", ""), ("A", "."), ("GC", "()"), ("ACGU" * 3, "." * 12)]
    for _ in range(n):
        k = rng.randint(1, 70)
        out.append(("".join(rng.choice("ACGU") for _ in range(k)), "".join(rng.choice("(().)).") for _ in range(k))))
    return [(i, q, s) for i, (q, s) in enumerate(out)]


def plain_pairs(s):
    stack, pairs = [], []
    for i, c in enumerate(s):
        if c == "(":
            stack.append(i)
        elif c == ")" and stack:
            pairs.append((stack.pop(), i))
    return sorted(pairs)


def plain_helices(pairs):
    out = []
    for i, j in pairs:
        if out and i == out[-1][0] + out[-1][2] and j == out[-1][1] - out[-1][2]:
            out[-1][2] += 1
        else:
            out.append([i, j, 1])
    return [tuple(x) for x in out]


def plain_runs(s, ch="."):
    at = 0
    for key, g in itertools.groupby(s):
        n = len(list(g))
        if key == ch:
            yield at, at + n, n
        at += n


@pytest.fixture(scope="module")
def folds(spark):
    return spark.createDataFrame(random_folds(), "id long, seq string, struct string")


def test_structure_functions_against_plain_python(folds):
    s = F.col("struct")
    x = folds.select("id", "struct", st.base_pairs(s).alias("p"), st.stem_runs(st.base_pairs(s)).alias("r"), st.bulges(s).alias("b"), st.apical_loop(s).alias("a"), st.pair_map(s).alias("m"))
    for r in x.collect():
        pairs = plain_pairs(r.struct)
        assert [tuple(p) for p in r.p] == pairs
        assert [tuple(p) for p in r.r] == plain_helices(pairs)
        runs = list(plain_runs(r.struct))
        assert [tuple(b) for b in r.b] == runs
        assert (tuple(r.a) if r.a else None) == (max(runs, key=lambda b: (b[2], -b[0])) if runs else None)
        want = [-1] * len(r.struct)
        for i, j in pairs:
            want[i], want[j] = j, i
        assert r.m == want


def test_pair_and_bulge_features_against_plain_python(folds):
    x = folds.withColumns({"pairs": st.base_pairs(F.col("struct")), "b": st.bulges(F.col("struct"))}).withColumn("runs", st.stem_runs(F.col("pairs")))
    x = x.withColumn("sided", ft.sided_bulges(F.col("pairs"), F.col("b")))
    cols = ft.stems(F.col("seq"), F.col("pairs"), F.col("runs")) | ft.bulge_features(F.col("sided"))
    for r in x.select("seq", "struct", *[c.alias(k) for k, c in cols.items()]).collect():
        pairs = plain_pairs(r.struct)
        helices = [h[2] for h in plain_helices(pairs)]
        assert (r.helix_count, r.helix_max_len) == (len(helices), max(helices, default=0))
        assert r.helix_mean_len == pytest.approx(sum(helices) / len(helices) if helices else 0)
        gc = sum({r.seq[i], r.seq[j]} == {"G", "C"} for i, j in pairs) / max(len(pairs), 1)
        assert r.pct_GC_pairs == pytest.approx(gc)
        inside = []
        if pairs:
            lo, hi = min(i for i, _ in pairs), max(j for _, j in pairs)
            inside = [b for b in plain_runs(r.struct) if b[0] >= lo and b[1] <= hi + 1]
            left = [(b[0] + b[1] - 1) / 2 <= (lo + hi) / 2 for b in inside]
            assert r.bulge_chain_same_side_count == sum(a == b for a, b in zip(left, left[1:]))
            assert r.bulge_max_left == max((b[2] for b, on in zip(inside, left) if on), default=0)
        assert (r.bulge_count, r.bulge_chain_count) == (len(inside), max(len(inside) - 1, 0))


def test_featurize_has_all_columns(spark, folds):
    rows = ft.featurize(folds.withColumn("mfe", F.lit(-3.0))).collect()
    assert len(rows) == folds.count() and len(rows[0]) == 3 + 1 + 85
    assert all(r.len == len(r.seq) for r in rows)


def plain_duplexes(seq, struct, lengths=(21, 22, 23, 24)):
    partner = [-1] * len(struct)
    for i, j in plain_pairs(struct):
        partner[i], partner[j] = j, i
    runs = list(plain_runs(struct))
    lo, hi, _ = max(runs, key=lambda b: (b[2], -b[0])) if runs else (0, 0, 0)
    n = len(struct)
    near = lambda i: sum(p != -1 for p in partner[i : i + 6]) >= 3
    five = [i for i in range(min(max(0, lo - 1), n - 1) + 1) if not lo <= i < hi and near(i)][:30]
    three = [i for i in range(min(max(0, hi), n - 1), n) if not lo <= i < hi and near(i)][:30]
    for arm, starts in (("5p", five), ("3p", three)):
        for a in starts:
            for k in lengths:
                if a + k <= len(seq):
                    inside = [p for p in partner[a : a + k] if p != -1]
                    tail = len(struct[a : a + k]) - len(struct[a : a + k].rstrip(".")) if arm == "3p" else 0
                    yield arm, a, k, len(inside) / k, max(inside) - inside[0] if inside else 0, tail, (lo - a - k if arm == "5p" else a - hi)


def test_duplexes_against_plain_python(folds):
    got = {}
    for r in mature.duplex_candidates(folds).collect():
        got.setdefault(r.id, []).append((r.arm, r.start, r.length, r.feat_paired_frac, r.feat_overhang_proxy, r.feat_3p_tail_unpaired, r.feat_dist_loop))
    for i, q, s in random_folds():
        assert sorted(got.get(i, [])) == sorted(plain_duplexes(q, s) if s else [])


def test_arms_face_and_picks(spark):
    s = "((((((((....))))))))"
    df = spark.createDataFrame([(s,)], "s string").select(st.pair_map(F.col("s")).alias("p"))
    face = lambda *x: df.select(mature.arms_face(F.col("p"), *map(F.lit, x)).alias("f")).first().f
    assert face(0, 8, 12, 20) and not face(0, 8, 8, 12) and not face(0, 5, 15, 20) and not face(3, 3, 12, 20)
    c = spark.createDataFrame([("x", 1, 0.5), ("x", 0, 0.5), ("y", 2, None)], "id string, cand int, score double")
    assert {(r.id, r.cand) for r in mature.pick(c).collect() if r.id == "x"} == {("x", 0)}


def test_truth_relevance_and_metrics(spark):
    m = spark.createDataFrame([("b", "5p", "CGU"), ("b", "3p", "GGG"), ("c", "5p", "A")], "base_id string, arm string, seq string")
    p = spark.createDataFrame([("b", "ACGUACGU")], "base_id string, pre string")
    assert [(r.arm, r.t_start, r.t_len) for r in mature.locate(m, p).collect()] == [("5p", 1, 3)]
    x = spark.createDataFrame([("5p", 3, 22, "5p", 3, 22), ("5p", 3, 21, "5p", 3, 22), ("5p", 5, 22, "5p", 3, 22), ("3p", 3, 22, "5p", 3, 22), ("5p", 3, 22, None, None, None)], "arm string, start int, length int, t_arm string, t_start int, t_len int")
    got = mature.ranking_metrics(x).first()
    assert (got.n, got.exact, got.near, got.start, got.arm, got.length_wrong) == (5, 0.2, 0.6, 0.4, 0.6, 0.2)
    rel = x.select(mature.relevance(F.col("start"), F.col("length"), F.col("t_start"), F.col("t_len")).alias("r"))
    assert [r.r for r in rel.collect()] == [2, 1, 1, 2, 0]


def test_models_round_trip(spark, tmp_path):
    rows = [(i, i % 2, float(i % 2) + i % 3 / 10, float("nan") if i % 5 == 0 else 1.0) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, label int, a double, b double")
    cols = ["a", "b", "absent"]
    model = models.train_forest(df, cols, trees=5, depth=3)
    got = models.score(df, model, cols)
    assert all(r.pred_label == r.label for r in got.collect()) and got.columns == [*df.columns, "rf_score", "pred_label"]
    models.save(model, cols, str(tmp_path / "m"), 0.0, {"neg_q95": 0.4, "q99": 0.9})
    again, features, cut, reference = models.load(spark, str(tmp_path / "m"))
    assert (features, cut, reference) == (cols, 0.0, {"q90": None, "q95": 0.4, "q99": 0.9})
    assert {r.pred_label for r in models.score(df, again, cols, cut).collect()} == {1}
    assert models.importances(spark, model, cols).first().feature == "a"
    for how in ("isotonic", "sigmoid"):
        c = models.calibrated(got, models.calibrate(got, how)).groupBy("label").agg(F.avg("calibrated").alias("c")).collect()
        assert {r.label: r.c > 0.5 for r in c} == {0: False, 1: True}


def test_audits_and_reextraction(spark):
    c = spark.createDataFrame([("x",), ("y",)], "candidate_id string")
    h = spark.createDataFrame([("x", 0.9)], "candidate_id string, rf_score double")
    rows, audit = models.with_audit(c, h)
    assert rows.count() == 2 and [(r.candidate_id, r.reject_reason) for r in audit.collect()] == [("y", "NoHairpin")]
    v = spark.createDataFrame([("a", 0.5, "WEAK"), ("b", 0.5, "WEAK"), ("c", 0.1, "WEAK")], "id string, b_score double, verdict string")
    n = spark.createDataFrame([("a", 0.5, "HIGH"), ("b", 0.6, "HIGH")], "id string, b_score double, verdict string")
    assert {r.id: r.verdict for r in models.reextracted(v, n).collect()} == {"a": "WEAK", "b": "HIGH", "c": "WEAK"}
    with pytest.raises(ValueError, match="y"):
        stages.complete_join(c, h, "candidate_id")


def test_scan_choice_and_pads_with_nulls_and_ties(spark):
    rows = [("x", 70, None, 1, 50), ("x", 100, 0.5, 1, 50), ("y", 70, float("nan"), 1, 50), ("z", 70, 0.25, 1, 50), ("z", 100, 0.25, 0, 40)]
    df = spark.createDataFrame(rows, "base_id string, pad int, rf_score double, pred_label int, hp_len int")
    assert {(r.base_id, r.pad) for r in collapse.best_of_scan(df, ["base_id"], ties=["pad"]).collect()} == {("x", 100), ("z", 70)}
    got = {r.base_id: (r.best_pad, r.is_tie, r.pad_scores) for r in collapse.collapse_pads(df).collect()}
    assert got == {"x": (100, False, "100:0.500000"), "z": (70, True, "70:0.250000,100:0.250000")}
    near = [("n", 70, 0.1234561, 1, 50, "a"), ("n", 100, 0.1234562, 1, 50, "b"), ("n", 100, 0.1, 0, 60, "c"), ("n", None, 0.05, 0, 60, "d")]
    near = spark.createDataFrame(near, "base_id string, pad int, rf_score double, pred_label int, hp_len int, note string")
    r = collapse.collapse_pads(near, ["note"]).first()
    assert (r.best_pad, r.is_tie, r.note, r.best_rf_score, r.pads_seen) == (100, False, "b", 0.123456, "70,100") and r.pad_scores == "70:0.123456,100:0.100000"
    assert {tuple(r) for r in collapse.pad_rejects(df).collect()} == {("y", "MissingPadVariant"), ("y", "NoNumericRFScore")}


def test_repeat_words(spark):
    words = [("no", ""), (" NA ", ""), ("NULL", "NULL"), (".", "."), ("LINE/L1", "LINE"), ("na/x", "NA"), (None, "")]
    df = spark.createDataFrame(words, "w string, want string")
    assert all(r.got == r.want for r in df.select(labels.norm_repeat(F.col("w")).alias("got"), "want").collect())


def test_gff3_strand_and_blanks(spark, tmp_path):
    p = tmp_path / "a.gff3"
    p.write_text("chr1\t.\tmiRNA\t11\t30\t.\t?\t.\tName= mir-1 ;x=1\n")
    r = readers.read_gff3(spark, str(p), "db").first()
    assert (r.k_start0, r.k_end0, r.k_strand, r.known_id) == (10, 30, ".", "mir-1")


def test_rescue_multi(spark):
    key = "chrom string, strand string, island_start long, pos long"
    multi = spark.createDataFrame([("c", "+", 0, 10), ("c", "+", 0, 30), ("c", "+", 0, 90)], key)
    unique = spark.createDataFrame([("c", "+", 0, 20)], key)
    signal = spark.createDataFrame([("c", "+", 0, 12, 1), ("c", "+", 0, 90, 4)], key + ", u long")
    assert sorted(r.pos for r in stages.rescue_multi(multi, unique, signal).collect()) == [30, 90]
