"""Physical plans: what reaches the scan, how often rows are shuffled."""

import pytest

from tallymark.operators import replay, rules
from tallymark.sources import adapter, store

AS_OF = adapter.TIDY_AS_OF


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ledger"))
    tidy = adapter.tidy_ledger(spark, "/root/testdata/sf0.001")
    names = ("coupon_stocks", "issuances", "issuance_histories", "issuance_usages")
    store.write_tables({n: getattr(tidy, n) for n in names}, root)
    return tidy.with_tables(**store.read_tables(spark, root, names))


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges(df):
    return plan(df).split("== Physical Plan ==")[1].split("\n\n\n")[0].count(" Exchange (")


def test_as_of_filter_and_columns_reach_the_scan(ledger):
    text = plan(replay.replay_state(ledger.issuance_histories, AS_OF))
    assert "LessThanOrEqual(created_at,2003-01-01T00:00)" in text
    assert "ReadSchema: struct<id:bigint,issuance_id:bigint,to_status:string,created_at:timestamp_ntz>" in text


def test_replay_and_digest_shuffle_once(ledger):
    assert exchanges(replay.replay_state(ledger.issuance_histories, AS_OF)) == 1
    digest = replay.digest(ledger.issuance_histories, AS_OF, ledger.issuances, ledger.issuance_usages)
    assert exchanges(digest) == 1


def test_chain_shuffles_once(ledger):
    assert exchanges(rules.illegal_transition(replay.chain(ledger.issuance_histories, AS_OF))) == 1


def test_rules_have_no_pairwise_join(ledger):
    text = plan(rules.run_rules(ledger, AS_OF))
    assert "NestedLoop" not in text and "Cartesian" not in text
    # digest + its findings, two duplicate branches and their union, chain; dimensions are broadcast
    assert exchanges(rules.run_rules(ledger, AS_OF)) <= 8


def test_rules_use_no_python(ledger):
    assert "Python" not in plan(rules.run_rules(ledger, AS_OF))


def test_bucketed_tables_replay_without_a_shuffle(spark, ledger, tmp_path):
    import uuid

    name = f"histories_{uuid.uuid4().hex[:8]}"
    columns = ledger.issuance_histories
    store.conform(columns, "issuance_histories").write.bucketBy(4, "issuance_id").sortBy("issuance_id").option(
        "path", str(tmp_path / name)
    ).saveAsTable(name)
    try:
        assert exchanges(replay.replay_state(spark.table(name), AS_OF)) == 0
    finally:
        spark.sql(f"DROP TABLE {name}")
