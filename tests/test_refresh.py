"""Incremental gold refresh against a full rebuild."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from cellgrid.operators import layers, refresh
from cellgrid.sources.adapters import bronze_from_events
from cellgrid.sources.sinks import write_layer

SF = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in df.select(*cols).collect())


def _files(path):
    return {p for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def _append(df, path):
    df.write.mode("append").partitionBy("date", "region").parquet(path)


@pytest.mark.parametrize(("grain", "strict"), [("hour", False), ("hour", True), ("day", True)])
def test_late_files_give_the_same_gold_as_a_full_rebuild(spark, tmp_path, grain, strict):
    s, g, state = (str(tmp_path / n) for n in ("silver", "gold", "state"))
    silver = layers.silver(bronze_from_events(spark, SF)).cache()
    dates = sorted(r[0] for r in silver.select("date").distinct().collect())
    late_day, lost_day = dates[len(dates) // 2], dates[2]
    late = (F.col("date") == F.lit(late_day)) & (F.pmod(F.xxhash64("cell_id", "ts"), F.lit(2)) == 0)
    write_layer(silver.filter(~late), s)

    def full():
        return layers.gold(refresh._layer(spark, s), grain=grain, strict_label=strict)

    first = refresh.refresh_gold(spark, s, g, state, grain, strict)
    assert len(first.rebuilt) == silver.filter(~late).select("date", "region").distinct().count() and not first.relabelled
    assert _rows(refresh._layer(spark, g)) == _rows(full())
    was = _files(g)
    again = refresh.refresh_gold(spark, s, g, state, grain, strict)
    assert (again.rebuilt, again.relabelled, again.emptied) == ([], [], []) and _files(g) == was

    _append(silver.filter(late), s)
    second = refresh.refresh_gold(spark, s, g, state, grain, strict)
    assert second.rebuilt and {d for d, _ in second.rebuilt} == {late_day}
    assert _rows(refresh._layer(spark, g)) == _rows(full())
    written = {(str(d), r) for d, r in second.rebuilt + second.relabelled}
    changed = was ^ _files(g)
    assert changed and {(p.split("date=")[1][:10], p.split("region=")[1].split("/")[0]) for p in changed} <= written
    assert len(was & _files(g)) > len(was) / 2

    # a day of which every file goes
    write_layer(silver.filter(F.col("date") != F.lit(lost_day)), s)
    third = refresh.refresh_gold(spark, s, g, state, grain, strict)
    assert third.emptied and {d for d, _ in third.emptied} == {lost_day}
    assert _rows(refresh._layer(spark, g)) == _rows(full())


def test_an_interrupted_refresh_is_applied_by_the_next(spark, tmp_path, monkeypatch):
    s, g, state = (str(tmp_path / n) for n in ("silver", "gold", "state"))
    silver = layers.silver(bronze_from_events(spark, SF)).cache()
    late = F.pmod(F.xxhash64("cell_id", "ts"), F.lit(50)) == 0
    write_layer(silver.filter(~late), s)
    refresh.refresh_gold(spark, s, g, state)
    _append(silver.filter(late), s)
    apply = refresh._apply

    def stops(*args):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(refresh, "_apply", stops)
    with pytest.raises(RuntimeError):
        refresh.refresh_gold(spark, s, g, state)
    assert os.path.exists(f"{state}/pending")
    monkeypatch.setattr(refresh, "_apply", apply)
    assert refresh.refresh_gold(spark, s, g, state).rebuilt == []
    assert _rows(refresh._layer(spark, g)) == _rows(layers.gold(silver)) and not os.path.exists(f"{state}/pending")
