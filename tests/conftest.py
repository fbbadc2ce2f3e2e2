import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.schemas import RECORDS  # noqa: E402
from stationflow.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.ui.enabled": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="stationflow-"),
                             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


def ts(text: str) -> dt.datetime:
    """Naive UTC datetime from 'YYYY-MM-DD HH:MM[:SS]'."""
    return dt.datetime.fromisoformat(text)


def records_df(spark, rows):
    """rows: (station_id, state, bikes, places, ts_text) tuples; last_update = ts."""
    data = []
    for sid, state, bikes, places, t in rows:
        stamp = ts(t) if t else None
        data.append((sid, state, bikes, places, "CONNECTED", stamp, stamp))
    # Build from UTC text so the Python process zone cannot shift the instants.
    from pyspark.sql import functions as F
    df = spark.createDataFrame(
        [(a, b, c, d, e, f.isoformat() if f else None, g.isoformat() if g else None)
         for a, b, c, d, e, f, g in data],
        "station_id bigint, operational_state string, nb_available_bikes bigint, "
        "nb_available_places bigint, connexion string, last_update string, record_timestamp string")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       if f.name not in ("last_update", "record_timestamp")
                       else F.to_timestamp(F.concat(F.col(f.name), F.lit("Z"))).alias(f.name)
                       for f in RECORDS.fields])


def rows(df, *order):
    out = df.orderBy(*order) if order else df
    return [tuple(r) for r in out.collect()]
