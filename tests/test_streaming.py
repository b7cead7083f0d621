from tallyloom.operators.filters import nonempty_key
from tallyloom.streaming.landing import append_new, landed_stream


def test_each_file_is_taken_up_once(spark, tmp_path):
    landing, target, progress = (str(tmp_path / n) for n in ("landing", "norm", "progress"))
    schema = "ts_code string, v int"

    def land(month, data):
        spark.createDataFrame(data, schema).write.parquet(f"{landing}/vendor/daily/{month}")

    def run():
        query = append_new(landed_stream(spark, landing, schema), nonempty_key, target, progress)
        query.awaitTermination(120)

    land("202401", [("a", 1), ("", 2)])
    run()
    land("202402", [("b", 3), (None, 4)])
    run()
    run()
    got = spark.read.parquet(target)
    assert sorted((r.ts_code, r.v) for r in got.collect()) == [("a", 1), ("b", 3)]
    assert got.where("file_path like '%/202402/%'").count() == 1
