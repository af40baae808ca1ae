from helpers import EVENTS, event

from threadloom.operators import delivery


def _table(spark, tmp_path, rows, files=2):
    path = f"file://{tmp_path}/events"
    spark.createDataFrame(rows, EVENTS).repartition(files).write.parquet(path)
    return path


def test_first_row_of_each_identifier_stays(spark, tmp_path):
    rows = [event(3, msg_id="A"), event(1, msg_id=" a\t"), event(2, msg_id="　A "), event(4, msg_id=None), event(5, msg_id="  "), event(6, msg_id="b", text="x" * 100_000)]
    path = _table(spark, tmp_path, rows)
    assert sorted(r[0] for r in delivery.repeated_deliveries(spark, path).collect()) == [2, 3]
    kept = delivery.keep_first_delivery(spark, path)
    assert sorted(r.row_id for r in kept.collect()) == [1, 4, 5, 6]
    assert kept.columns == [c.strip().split()[0] for c in EVENTS.split(",")]


def test_vectors_loaded_in_tasks_give_the_same(spark, tmp_path):
    rows = [event(i, msg_id=f"m{i % 37}") for i in range(500)]
    path = _table(spark, tmp_path, rows, files=5)
    at_once = sorted(r[0] for r in delivery.repeated_deliveries(spark, path).collect())
    in_tasks = sorted(r[0] for r in delivery.repeated_deliveries(spark, path, limit=5000).collect())
    assert at_once == in_tasks == list(range(37, 500))


def test_ties_and_wholly_equal_rows_leave_one(spark, tmp_path):
    path = _table(spark, tmp_path, [event(7, msg_id="t")] * 3 + [event(None, msg_id="n"), event(None, msg_id="n")])
    kept = delivery.keep_first_delivery(spark, path).collect()
    assert sorted((r.msg_id, r.row_id) for r in kept) == [("n", None), ("t", 7)]


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert delivery.repeated_deliveries(spark, _table(spark, tmp_path, [])).count() == 0
    path = f"file://{tmp_path}/more"
    spark.createDataFrame([(1, "a", 5), (2, "A", 6)], "row_id bigint, msg_id string, `keep` int").write.parquet(path)
    assert [tuple(r) for r in delivery.keep_first_delivery(spark, path).collect()] == [(1, "a", 5)]


def test_hot_identifier_and_pairs_against_brute_force(spark, tmp_path):
    rows = [event(i, msg_id="hot" if i % 3 == 0 else f"m{i // 4}") for i in range(3000)]
    path = _table(spark, tmp_path, rows, files=4)
    seen, lost = set(), []
    for r in rows:
        if r[3] in seen:
            lost.append(r[0])
        seen.add(r[3])
    for limit in (1 << 26, 100):
        assert sorted(r[0] for r in delivery.repeated_deliveries(spark, path, limit=limit).collect()) == lost
        assert delivery.keep_first_delivery(spark, path, limit=limit).count() == len(seen)


def test_no_repeats_write_no_vectors(spark, tmp_path):
    path = _table(spark, tmp_path, [event(i, msg_id=f"m{i}") for i in range(50)])
    assert delivery.deletion_vectors(delivery.lost_rows(spark.read.parquet(path))).count() == 0
    assert delivery.keep_first_delivery(spark, path).count() == 50
