import pytest
from conftest import rows

from medallion.operators.enrich import JoinSpec, enrich
from medallion.streaming.enriched import ledger, read_enriched, start_enriched

DDL = "id bigint, k string"
HOT = [(i, "hot" if i % 3 == 0 else f"k{i % 40}") for i in range(120)]


def land(spark, path, data):
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(f"{path}/in")


def learn(spark, path, data):
    spark.createDataFrame(data, "lk string, n bigint").coalesce(1).write.mode("append").parquet(f"{path}/lookup")


def specs_of(path):
    def specs(session):
        known = session.read.schema("lk string, n bigint").parquet(f"{path}/lookup")
        return [JoinSpec(known, "l", "e.k = l.lk", ["l.n"], salts=8, hot_on=("e.k", "l.lk"))]

    return specs


def run(spark, path, checkpoint="cp", before_batch=None):
    arriving = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    calls = []

    def specs(session):
        calls.append(1)
        if before_batch and len(calls) > 1:  # the first call only takes the shape
            before_batch(len(calls) - 2)
        return specs_of(path)(session)

    query = start_enriched(arriving, "e", ["e.id", "e.k"], specs, f"{path}/out", f"{path}/{checkpoint}")
    query.awaitTermination()
    return read_enriched(spark, f"{path}/out")


def test_a_lookup_row_that_appears_between_two_batches(spark, tmp_path):
    learn(spark, tmp_path, [("a", 1)])
    for at in range(3):
        land(spark, tmp_path, [(2 * at, "a"), (2 * at + 1, "b")])
    out = run(spark, tmp_path, before_batch=lambda at: learn(spark, tmp_path, [("b", 2)]) if at == 1 else None)
    assert rows(out) == [(0, "a", 1), (1, "b", None), (2, "a", 1), (3, "b", 2), (4, "a", 1), (5, "b", 2)]
    versions = [r["version"] for r in ledger(spark, f"{tmp_path}/out").orderBy("__batch").collect()]
    assert versions[0] != versions[1] == versions[2]


def test_hot_keys_of_one_batch_are_spread_in_the_next(spark, tmp_path):
    learn(spark, tmp_path, [("hot", 7), *((f"k{i}", i) for i in range(40))])
    for part in range(3):
        land(spark, tmp_path, HOT[part * 40 : part * 40 + 40])
    out = run(spark, tmp_path)
    assert rows(out) == sorted((i, k, 7 if k == "hot" else int(k[1:])) for i, k in HOT)
    assert [r["hot"] for r in ledger(spark, f"{tmp_path}/out").orderBy("__batch").collect()] == [["hot"]] * 3
    land(spark, tmp_path, [(1000, "hot")])
    assert run(spark, tmp_path).where("id = 1000 AND n = 7").count() == 1  # after a restart


def test_a_lost_checkpoint_doubles_nothing(spark, tmp_path):
    learn(spark, tmp_path, [("hot", 7)])
    land(spark, tmp_path, HOT[:20])
    once = rows(run(spark, tmp_path))
    assert rows(run(spark, tmp_path, "another")) == once


def test_nothing_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    learn(spark, tmp_path, [])
    out = run(spark, tmp_path)
    assert out.columns == ["id", "k", "n"] and out.count() == 0


@pytest.mark.parametrize("hot", [[], ["hot"], ["hot", "none"]])
def test_only_hot_lookup_rows_are_copied(spark, hot):
    base = spark.createDataFrame([*HOT, (999, None)], DDL)
    lookup = spark.createDataFrame([("hot", 7), *((f"k{i}", i) for i in range(0, 40, 2))], "lk string, n bigint")
    spec = JoinSpec(lookup, "l", "e.k = l.lk", ["l.n"], salts=8, hot_on=("e.k", "l.lk"), hot=hot)
    plain = JoinSpec(lookup, "l", "e.k = l.lk", ["l.n"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enrich(base, "e", ["e.id", "e.k"], [spec])
        assert rows(out) == rows(enrich(base, "e", ["e.id", "e.k"], [plain]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    copies = [n for n in _outputs(out, "Generate")]
    assert copies == ([lookup.count() + 7] if hot else [])


def _outputs(df, node):
    """Rows that nodes of this name put out in the plan that ran."""
    def walk(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            yield from walk(plan.executedPlan())
            return
        if name == node:
            yield plan.metrics().apply("numOutputRows").value()
        if "QueryStage" in name:
            yield from walk(plan.plan())
        for i in range(plan.children().size()):
            yield from walk(plan.children().apply(i))

    yield from walk(df._jdf.queryExecution().executedPlan())
