"""Steps that hold on larger tables: what is exchanged, and the same rows by every way."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import graphs, identity, ranges, repeats, samples
from strandline.session import small_tasks
from strandline.sources import sinks


def test_only_blocks_that_share_a_site_are_dealt_to_each_other():
    rows = 600  # 200 sites of three carriers each; members of 100 blocks, each block with its own sites
    block, member, code = np.repeat(np.arange(100), 6), np.tile([0, 1, 2], 200), np.ones(rows, np.int64)
    after = np.repeat(np.arange(3, rows + 1, 3), 3)
    dealt = [b for part in identity._deal_pairs(after, block, member, code, 4, 100, 1) for b in part.to_pylist()]
    assert len(dealt) == 100 and all(d["low"] == d["high"] and len(d["first"]) == 6 for d in dealt)


@pytest.mark.parametrize("crowd", [0, 2, 1000])
def test_pairs_and_lists_of_a_site_count_alike(spark, crowd):
    rng = np.random.default_rng(2)
    rows = [(s, int(m) - 9, int(rng.integers(0, 3)), int(rng.integers(0, 3))) for s in range(30) for m in rng.choice(40, rng.integers(1, 30), replace=False)]
    gt = spark.createDataFrame(rows, "site_id long, sample_id long, alt long, called long")
    found = lambda *how: sorted(tuple(r) for r in identity.pair_counts(gt, *how).collect())
    assert found(False, 4, 50, crowd) == found(False, 1024) and found(True, 4, 50, crowd) == found(True, 1024)


def test_both_ways_reads_the_pairs_once(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5)], "sample_a long, sample_b long, relatedness double")
    both = identity.both_ways(pairs, "u", "v", "relatedness")
    assert sorted(tuple(r) for r in both.collect()) == [(1, 2, 0.5), (2, 1, 0.5)]
    assert "Union" not in both._jdf.queryExecution().optimizedPlan().toString()


def test_a_left_overlap_join_gives_no_numbers_to_rows(spark):
    a = spark.createDataFrame([("c", 0, 9), ("c", 0, 9), ("c", 50, 60), (None, 1, 2)], "chrom string, a_start long, a_end long")
    b = spark.createDataFrame([("c", 5, 7), ("c", 8, 20)], "chrom string, b_start long, b_end long")
    found = ranges.overlap_join(a, b, 4, "left")
    assert "monotonically" not in found._jdf.queryExecution().optimizedPlan().toString()  # they differ where a shuffle is read again
    want = [("c", 0, 9, 5, 7, 2), ("c", 0, 9, 8, 20, 1)] * 2 + [("c", 50, 60, None, None, None), (None, 1, 2, None, None, None)]
    assert sorted(map(str, (tuple(r[c] for c in ("chrom", "a_start", "a_end", "b_start", "b_end", "overlap_bp")) for r in found.collect()))) == sorted(map(str, want))


def test_a_ratio_on_an_exact_half_or_bound_rounds_one_way(spark):
    depths = [(1, "chr1", 0.1), (1, "chr2", 0.2), (1, "chr3", 0.3), (1, "chrY", 0.18)]  # 0.18 / 0.2, in floats either side of 0.9
    for rows in (depths, depths[::-1]):
        cov = spark.createDataFrame(rows, "sample_id long, chrom string, depth double").coalesce(1)
        assert samples.coverage_ratios(cov, 0.9).first()["sex"] == "XY"


def test_a_task_is_given_a_bounded_part(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    fresh = spark.newSession()
    assert small_tasks(fresh).conf.get(key) == "8m"
    fresh.conf.set(key, "3m")
    assert small_tasks(fresh).conf.get(key) == "3m"


def test_a_task_reads_a_bounded_part(spark, monkeypatch):
    from strandline import session
    from strandline.plans.bindings import Bound

    data, key = "/root/testdata/sf0.1", "spark.sql.files.maxPartitionBytes"
    assert small_tasks(spark.newSession()).conf.get(key) == "32m"
    size = session.stored_bytes(spark, f"{data}/lineitem.parquet")
    monkeypatch.setattr(session, "READ", "1m")
    assert Bound(spark.newSession(), data).lineitem.rdd.getNumPartitions() >= size >> 20
    fresh = spark.newSession()
    fresh.conf.set(key, "512k")
    assert small_tasks(fresh).conf.get(key) == "512k"


def test_exchanges_have_parts_for_their_input(spark, monkeypatch):
    from strandline import session
    from strandline.plans.catalogue import QUERIES

    data, key = "/root/testdata/sf0.001", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size = sum(session.stored_bytes(spark, f"{data}/{t}.parquet") for t in ("customer", "orders", "lineitem"))
    fresh = spark.newSession()
    for share in (size // 50, size // 10, size):
        monkeypatch.setattr(session, "INPUT_A_PART", share)
        parts = max(-(-size // share), 4)  # 4: the session's shuffle partitions
        plan = QUERIES["agg22"](fresh, data)._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"hashpartitioning\(.*, (\d+)\)", plan)) == {str(parts)}
    fresh.conf.set(key, "7")
    QUERIES["agg22"](fresh, data)
    assert fresh.conf.get(key) == "7"


def test_values_of_islands_that_have_the_same_are_made_once(spark, tmp_path):
    from strandline.plans import qtl as plans
    from strandline.plans.bindings import Bound

    spark.createDataFrame([(k, k % 50 + 1, "b", "t") for k in range(450)], "p_partkey long, p_size int, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    events = [(m, e, float(m)) for m in range(3) for e in ("view", "signup", "click", "purchase", "error") for _ in range(20)]
    spark.createDataFrame(events, "user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    b = Bound(spark, str(tmp_path))
    values, of = plans._islands(b)
    assert values.count() == 45 * 3 and of.count() == 450  # not 450 * 3
    whole = spark.sql(plans._ISLANDS, regions=b.regions, methyl=b.methyl).select("island", "sample_id", "value")
    named = of.select("island", "profile").join(values.select(F.col("island").alias("profile"), "sample_id", "value"), "profile").drop("profile")
    assert sorted(map(tuple, named.collect())) == sorted(map(tuple, whole.collect()))


def test_sums_of_the_grid_need_no_grid(spark):
    gt = spark.createDataFrame([(1, 1, 2, 2), (1, 2, None, 0), (2, 3, 1, 1), (9, 1, 1, 1), (1, 99, 1, 2)], "site_id long, sample_id long, alt int, called int")
    sites, members = spark.createDataFrame([(1,), (2,), (3,)], "site_id long"), spark.createDataFrame([(1, 5), (2, 7), (3, 11)], "sample_id long, position long")
    found = graphs.padded_sums(gt, sites, members)
    grid, alt = graphs.pad_members(gt, sites, members), F.coalesce("alt", F.lit(0))
    want = grid.groupBy("site_id").agg(F.count("*"), F.count_if(F.col("called") == 0), F.sum(alt), F.sum(F.col("position") * (F.col("called") + 3 * alt + 1)))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_a_shard_is_one_file(spark, tmp_path):
    rows = spark.createDataFrame([(i, "c", i * 1000, i * 1000 + 10) for i in range(400)], "id long, chrom string, a_start long, a_end long").repartition(7)
    shards = spark.createDataFrame([(f"c_{k}", "c", k * 200_000, (k + 1) * 200_000) for k in range(2)], "shard string, chrom string, b_start long, b_end long")
    sinks.write_by_shard(rows, shards, str(tmp_path / "out"))
    assert [len(list((tmp_path / "out" / f"shard=c_{k}").glob("*.parquet"))) for k in range(2)] == [1, 1]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400


def test_lines_of_a_cohort_are_written_small(spark, tmp_path):
    body = spark.createDataFrame([("./.:.\t" * 5000,)], "value string")
    sinks.write_vcf(body, str(tmp_path / "a.vcf"), spark.createDataFrame([(1, 1)], "sample_id long, position long"))
    assert sum(f.stat().st_size for f in (tmp_path / "a.vcf").glob("part-*")) < 3000
    assert spark.read.text(str(tmp_path / "a.vcf")).count() == 3


def test_the_repeat_screen_is_small_enough_to_be_compiled(spark):
    from strandline.plans.catalogue import QUERIES

    fresh = spark.newSession()
    fresh.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans have no code yet
    plan = QUERIES["sta10"](fresh, "/root/testdata/sf0.001")
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000  # a larger method stays interpreted, about six times as slow


def test_classes_of_odd_thresholds(spark):
    schema = "locus_id long, assessable string, inheritance string, motif_len int, benign_min double, benign_max double, intermediate_min double, intermediate_max double, pathogenic_min double"
    loci = [(1, "no", "AD", 3, 1.0, 9.0, None, None, 2.0), (2, None, "AR", 3, None, 4.0, 6.0, 7.0, 9.0), (3, "yes", "AD", 3, None, None, 5.0, None, None), (4, "yes", "AD", 3, 2.0, None, None, None, 4.0)]
    calls = [(m, c, 3 * a, 3 * a) for m in range(1, 5) for c, a in enumerate((0, 1, 3, 5, 6, 9))] + [(2, 9, 6, 60), (2, 8, None, None)]
    screen = repeats.tr_screen(spark.createDataFrame(calls, "locus_id long, call_id long, al1 long, al2 long"), spark.createDataFrame(loci, schema), 3)
    got = {(r["locus_id"], r["call_id"]): (r["class1"], r["class2"], r["class"], r["mode_match"], r["borderline"]) for r in screen.collect()}
    of = lambda m: [got[m, c][0] for c in range(6)]
    assert of(1) == ["not_assessable"] * 6 and of(3) == ["below_pathogenic"] * 6
    assert of(2) == ["normal"] * 3 + ["above_benign", "intermediate", "pathogenic"] and of(4) == ["below_benign"] * 2 + ["below_pathogenic"] + ["pathogenic"] * 3
    assert got[2, 9] == ("pathogenic", "normal", "pathogenic", "carrier", False) and got[2, 8] == ("above_benign", "above_benign", "above_benign", "none", True)
    assert [got[2, c][4] for c in range(6)] == [False, False, False, True, True, True] and not any(got[1, c][4] for c in range(6))


def test_statistics_of_a_locus_meet_the_calls_once(spark):
    from strandline.plans.bindings import Bound
    from strandline.plans.repeats import _outliers

    plan = _outliers(Bound(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # the expansions found are kept; carriers are counted among them


def test_shares_of_a_locus_need_no_second_reading_of_single_alleles(spark):
    from strandline.plans.catalogue import QUERIES

    plan = QUERIES["agg49"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_a_ranking_of_some_thousand_members_is_one_round(spark):
    saved = []
    frames = spark.range(3000).select(F.col("id").alias("site_id"), F.col("id").alias("sample_id"), F.lit(0).alias("class")), spark.range(3000).select(F.col("id").alias("sample_id"), F.col("id").alias("position"))
    got = graphs.greedy_rank(spark, *frames, lambda df, name: saved.append(name) or df)
    assert saved == ["carriers"] and [r["sample_id"] for r in got.orderBy("rank").collect()] == list(range(3000))


def test_a_line_costs_its_genotypes_not_its_members(spark):
    sites = spark.createDataFrame([(1, "c", 5, "DEL"), (2, "c", 6, "INS"), (3, "d", 7, "DUP")], "site_id long, chrom string, pos long, svtype string")
    members = spark.createDataFrame([(10, 3), (11, 1), (12, 9), (13, 2), (14, 2)], "sample_id long, position long")
    gt = spark.createDataFrame([(1, 11, 1, 2, 7), (1, 12, 2, 2, 8), (2, 14, None, 0, None), (2, 10, 1, 1, 4), (1, 99, 1, 2, 3)], "site_id long, sample_id long, alt int, called int, dp long")
    body = sinks.vcf_lines(sites, gt, members)
    none = "./.:."
    want = {1: ["0/1:7", none, none, none, "1/1:8"], 2: [none, none, "./.:.", "./1:4", none], 3: [none] * 5}
    assert {r["site_id"]: r["value"].split("\t")[9:] for r in body.collect()} == want
    plan = body._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan and "try_element_at" not in plan  # no look-up for each member


def test_two_genotypes_of_a_member_at_a_site_are_no_line(spark):
    sites, members = spark.createDataFrame([(1, "c", 5, "DEL")], "site_id long, chrom string, pos long, svtype string"), spark.createDataFrame([(1, 1)], "sample_id long, position long")
    gt = spark.createDataFrame([(1, 1, 1, 2, 7), (1, 1, 2, 2, 8)], "site_id long, sample_id long, alt int, called int, dp long")
    with pytest.raises(Exception, match="two genotypes"):
        sinks.vcf_lines(sites, gt, members).collect()


def test_pairs_take_about_two_bytes():
    rng = np.random.default_rng(1)
    values = np.concatenate([np.sort(rng.integers(0, 9 << 20, 600)), [7], np.sort(rng.integers(0, 1 << 34, 3))])
    packed = identity._pack(values, np.array([0, 600, 601]))
    assert len(packed[0].as_py()) < 600 * 1.5  # units of two bytes
    back = identity._Unpacked(packed)
    assert [list(back.row(i)) for i in range(3)] == [list(values[:600]), [7], list(values[601:])]
    assert list(identity._Unpacked(packed.slice(1, 2)).row(1)) == list(values[601:])
    assert list(identity._Unpacked(identity._pack(np.array([300, 0, 5]), np.array([0]), False)).plain(0)) == [300, 0, 5]
    assert identity._Unpacked(identity.pa.nulls(2, identity.pa.list_(identity.pa.int16()))).begin.tolist() == [0, 0, 0]


def _related(spark):
    rng = np.random.default_rng(5)
    rows = [(s, int(m), int(rng.integers(0, 3)), int(rng.integers(1, 3))) for s in range(60) for m in rng.choice(40, rng.integers(1, 9), replace=False)]
    gt = spark.createDataFrame(rows, "site_id long, sample_id long, alt long, called long")
    return gt, identity.relatedness(gt)


def test_what_tasks_keep_of_pairs_gives_what_all_pairs_give(spark):
    gt, pairs = _related(spark)
    both = identity.both_ways(pairs, "sample_id", "relative", "relatedness")
    order = F.struct("relatedness", -F.col("relative"))
    top = lambda rows: sorted(map(tuple, rows.where("relatedness is not null").groupBy("sample_id").agg(F.max_by(F.struct("relative", "relatedness"), order)).collect()))
    best = identity.relatedness(gt, identity.best_of_each)
    assert best.count() < pairs.count() and top(identity.both_ways(best, "sample_id", "relative", "relatedness")) == top(both)
    near = both.groupBy("sample_id").agg(F.count_if(F.col("relatedness") >= -1.0), F.max("relatedness"))
    assert sorted(map(tuple, identity.close_partners(gt, -1.0).collect())) == sorted(map(tuple, near.collect()))
    low = identity.relatedness(gt, identity.one_of_each(lambda found: found.relatedness < -0.5))
    members = lambda rows: {r[0] for r in rows.select(F.explode(F.array("sample_a", "sample_b"))).collect()}
    assert low.count() < pairs.where("relatedness < -0.5").count() and members(low) == members(pairs.where("relatedness < -0.5"))
    some = identity.relatedness(gt, lambda found: found.relatedness >= -1.0, ("sample_a", "sample_b", "relatedness"))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, pairs.where("relatedness >= -1").select("sample_a", "sample_b", "relatedness").collect()))


def test_declared_pairs_are_counted_without_all_pairs(spark):
    gt, pairs = _related(spark)
    declared = spark.createDataFrame([(a, b, "father") for a in range(0, 40, 3) for b in (a // 2, a + 1, 999)], "child long, parent long, role string")
    found = identity.declared_relatedness(declared, gt)
    assert sorted(map(str, found.collect())) == sorted(map(str, identity.declared_pairs(declared, pairs).collect()))
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_what_a_kept_table_was_shuffled_through_is_gone(spark):
    import os

    from strandline.plans.bindings import Bound
    from strandline.plans.saving import kept_calls

    b, key = Bound(spark.newSession(), "/root/testdata/sf0.001"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = lambda: {f for at in spark._jvm.org.apache.spark.util.Utils.getConfiguredLocalDirs(spark._jsc.sc().conf()) for d, _, files in os.walk(at) for f in files if f.startswith("shuffle_")}
    before = own()
    assert kept_calls(b).count() > 0
    made = {f.split("_")[1] for f in own() - before}
    assert len(made) <= 1  # the count's own; the genotypes went through three
    assert key not in b.spark.conf.getAll


def test_a_ranking_is_kept_as_it_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(graphs, "OUT", 700)
    saved = []

    def save(df, name):
        saved.append(name)
        df.write.parquet(str(tmp_path / str(len(saved))))
        return spark.read.parquet(str(tmp_path / str(len(saved))))

    carriers = spark.range(3000).select(F.col("id").alias("site_id"), F.col("id").alias("sample_id"), F.lit(0).alias("class"))
    members = spark.range(3100).select(F.col("id").alias("sample_id"), (-F.col("id")).alias("position"))
    related = spark.createDataFrame([(5, 9, 0.5), (9, 99999, 0.5)], "sample_a long, sample_b long, relatedness double")
    got = graphs.greedy_rank(spark, carriers, members, save, related=related)
    rows = [(r["rank"], r["sample_id"], r["tier"], r["related_to"], r["relatedness"], r["cum_ge5"]) for r in got.orderBy("rank").collect()]
    first = [m for m in range(2999, -1, -1) if m != 5]
    want = [(i + 1, m, "unrelated", None, None, i + 1) for i, m in enumerate(first)] + [(3000 + i, m, "unrelated", None, None, 2999) for i, m in enumerate(range(3099, 2999, -1))] + [(3100, 5, "related", 9, 0.5, 3000)]
    assert rows == want and saved.count("ranks") == 4


def test_files_of_samples_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_FILES", 5)
    gt = spark.range(60).select((F.col("id") % 30).alias("sample_id"), F.col("id").alias("site_id"), F.lit(1).alias("alt"), F.lit(2).alias("called"))
    sinks.write_by_sample(gt, str(tmp_path / "out"), False)
    files = list((tmp_path / "out").glob("sample_id=*/*.parquet"))
    assert len(files) == 30 and len({f.name.split("-")[1] for f in files}) > 1  # small rows were all written by one task
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60
    assert small_tasks(spark.newSession()).conf.get("spark.sql.files.openCostInBytes") == "1m"
