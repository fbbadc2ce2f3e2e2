from pyspark.sql import functions as F

from stationflow.functions.timefn import hour_axis_label
from stationflow.sources import tables


def test_hour_axis_labels_every_third_hour(spark):
    got = [r[0] for r in spark.range(24).orderBy("id").select(hour_axis_label("id")).collect()]
    assert [x for x in got if x] == ["0h", "3h", "6h", "9h", "12h", "15h", "18h", "21h"] and got[1] is None


def test_stations_table_and_replace(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_stations")
    spark.sql("DROP TABLE IF EXISTS t_copy")
    tables.create_stations_table(spark, "t_stations", str(tmp_path / "stations"))
    assert "id" in spark.table("t_stations").columns
    tables.replace_table(spark.range(3).select(F.col("id")), "t_copy")
    tables.replace_table(spark.range(5).select(F.col("id")), "t_copy")
    assert spark.table("t_copy").count() == 5
    spark.sql("DROP TABLE t_stations")
    spark.sql("DROP TABLE t_copy")


def test_session_without_a_shared_folder_is_told_so():
    import pytest

    from stationflow.session import checkpoint_dir

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
