import os
import random
import time

from pyspark.sql import functions as F

from cardamom.llm import _common as C
from cardamom.llm import simhash as S


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in manager.getAllFiles().mkString("\n").split("\n") if os.path.basename(x).startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before, key = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(key)
    held = C.Staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    end = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert held.read().agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(key) == own


def test_a_table_is_its_parts_alone_and_of_few_files(spark):
    held = C.Staged(C.at_most(spark.range(1000).repartition(40, "id"), 3), "ids")
    names = os.listdir(held.path.removeprefix("file://"))
    assert 0 < len(names) <= 3 and all(x.startswith("part-") for x in names)
    assert held.read().count() == 1000


def test_tasks_follow_the_size_of_the_rows(spark, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert C.tasks_for(rows) == 4 * cores
    size = sum(os.path.getsize(tmp_path / "t" / x) for x in os.listdir(tmp_path / "t") if x.startswith("part-"))
    with C.settings(spark, {"spark.sql.files.maxPartitionBytes": "1k"}):
        assert C.tasks_for(rows) == max(4 * cores, -(-size // 1024)) > 4 * cores
    assert C.tasks_for(spark.createDataFrame([(1,)], "a long").join(rows)) > 10**9  # of unknown size: as many as there are


def test_near_duplicates_deletes_tables_that_it_has_read(spark, monkeypatch):
    """Large tables of shingles do not wait for the end."""
    log = []
    init, drop = C.Staged.__init__, C.Staged.drop
    monkeypatch.setattr(C.Staged, "__init__", lambda self, df, name: (init(self, df, name), log.append(f"+{name}"))[0])
    monkeypatch.setattr(C.Staged, "drop", lambda self: (drop(self), log.append(f"-{os.path.basename(self.path).rpartition('-')[0]}"))[0])
    rows = [(k, " ".join(f"w{k % 5}x{j}" if j % 20 else f"v{k}" for j in range(60))) for k in range(40)]
    groups = S.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert groups.count() == 40
    assert log.index("-signatures") < log.index("+similar-links")
    assert len(log) - 1 - log[::-1].index("-neighbours") < log.index("+many-texts")


def test_stages_give_few_pieces(spark, tmp_path):
    """Not one for each shuffle partition: each piece is a file, and so a started command."""
    import corpus_pipeline

    rows = [(k, f"a few words of text {k}", "web", "en") for k in range(2000)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    with C.settings(spark, {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        corpus_pipeline.mixing(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / "mixed"))
    names = [x for x in os.listdir(tmp_path / "mixed") if x.startswith("part-")]
    assert 0 < len(names) <= C.tasks_for(docs) < 61
    assert spark.read.parquet(str(tmp_path / "mixed")).count() == 2000


def test_first_shingles_are_put_in_order_in_parts(spark):
    """The rows of the whole; each part is its own write, whose shuffle files go before the next."""
    rows = spark.range(6000).select(F.xxhash64(F.col("id") % 500).alias("token"), F.col("id").alias("node"), (F.col("id") % 90).cast("int").alias("size"), F.lit(1).alias("pos"))
    found, made = [], []
    for slices in (1, 4):
        made.append([])
        table = lambda df, name: made[-1].append(C.Staged(df, name)) or made[-1][-1].read()  # noqa: B023, E731
        got = S.neighbours(rows, table, slices)
        links = {tuple(r) for r in got.filter("n_node is not null").select("token", "node", "n_node", "n_size").collect()}
        found.append((links, {tuple(r) for r in got.select("token", "node").collect()}))  # a range lists its ends again
    assert found[0] == found[1] and len(found[0][1]) == 6000
    assert len(found[0][0]) == 6000 - 500
    tokens = [{r[0] for r in t.read().select("token").distinct().collect()} for t in made[1]]
    assert len(made[0]) == 1 and sum(map(len, tokens)) == 500 == len(set.union(*tokens)) and 0 < min(map(len, tokens)) and len(tokens) == 4


def test_families_are_compared_in_rounds(spark, monkeypatch):
    """What a round shuffles does not grow with the square of a family."""
    from test_simhash import jaccard_groups, variants

    made, rows = [], variants(random.Random(2), 150, 4)
    init = C.Staged.__init__
    monkeypatch.setattr(C.Staged, "__init__", lambda self, df, name: (init(self, df, name), made.append(name))[0])
    for name, value in (("BLOCK_SHINGLES", 3_000), ("FEW", 8), ("ROUND", 1_000), ("SLICED", 100)):
        monkeypatch.setattr(S, name, value)
    got = dict(map(tuple, S.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == jaccard_groups(rows)
    assert made.count("family-links") > 4 and made.count("neighbours") == 1 + S.SLICES


def test_copies_do_not_make_a_shingle_common(spark):
    copies = [(1, "one text of seven words for all")] * 40
    shared = [(10 + k, f"a line that ten texts have {k}") for k in range(10)]
    hashes, counts = S.common_shingles(spark.createDataFrame(copies + shared, "node long, text string"), 5)
    assert set(hashes.tolist()) == {int(x) for x in S._set_hashes("a line that ten texts have", 5)} and set(counts.tolist()) == {10}


def test_run_deletes_the_stages_that_it_has_read(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    live, most = set(), []
    init, drop = C.Staged.__init__, C.Staged.drop
    monkeypatch.setattr(C.Staged, "__init__", lambda self, df, name: (init(self, df, name), name.startswith("pipeline-") and (live.add(self.path), most.append(len(live))))[0])
    monkeypatch.setattr(C.Staged, "drop", lambda self: (drop(self), live.discard(self.path))[0])
    same = lambda spark, docs, sf_dir: docs
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(f"s{k}", same) for k in range(5)])
    spark.range(50).withColumnRenamed("id", "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 50
    assert most == [1, 2, 2, 2]
