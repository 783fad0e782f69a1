"""Publication of a whole set of tables, and runs that go on after a failure."""

import pytest

from orderflow.models.forest import ForestSize
from orderflow.plans import catalog, pipeline
from orderflow.sources import tables, versions

SMALL = {"tie_breakers": catalog.TYPED_TIE_BREAKERS, "demand_size": ForestSize(2, 2)}


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return catalog.export_retail(spark, sf_dir), catalog.export_logistics(spark, sf_dir)


def job(spark, inputs, out, trees=2):
    pipeline.run_pipeline(spark, *inputs, out, **SMALL, delay_size=ForestSize(trees, 2))


def rows(spark, out, name="model_delay_metrics"):
    return sorted(map(tuple, tables.read_table(spark, out, name).collect()))


def test_a_stopped_run_leaves_the_old_set_and_goes_on(spark, inputs, tmp_path, monkeypatch):
    out = f"file:{tmp_path}/out"
    job(spark, inputs, out)
    first = versions.published(spark, out)
    assert set(first["tables"]) == set(tables.TABLES) and first["before"] is None
    old = {name: tables.read_table(spark, out, name).count() for name in tables.TABLES}
    old_files = tables.read_table(spark, out, "retail_cleaned").inputFiles()

    # stopped in the second training, when half of the tables are written
    with monkeypatch.context() as broken:
        broken.setattr(pipeline.demand, "train_demand_model", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job(spark, inputs, out, trees=3)
    assert versions.published(spark, out) == first
    assert {name: tables.read_table(spark, out, name).count() for name in tables.TABLES} == old
    assert tables.read_table(spark, out, "retail_cleaned").inputFiles() == old_files

    # the next run parses no CSV and does not train the first model again
    with monkeypatch.context() as again:
        again.setattr(pipeline, "read_retail_csv", lambda *a, **k: 1 / 0)
        again.setattr(pipeline, "read_logistics_csv", lambda *a, **k: 1 / 0)
        again.setattr(pipeline.delay, "train_delay_model", lambda *a, **k: 1 / 0)
        job(spark, inputs, out, trees=3)
    second = versions.published(spark, out)
    assert second["before"] == first["version"] and second["version"] != first["version"]
    assert {name: tables.read_table(spark, out, name).count() for name in tables.TABLES} == old
    files = versions.Files(spark)
    assert set(files.names(f"{out}/versions")) == {first["version"], second["version"]}
    assert not files.exists(f"{out}/versions/{second['version']}/_work")
    assert files.names(f"{out}/csv") and not files.exists(f"{out}/versions/{second['version']}/csv")

    # a published run is not repeated
    with monkeypatch.context() as none:
        none.setattr(pipeline, "_build", lambda *a, **k: 1 / 0)
        job(spark, inputs, out, trees=3)
    assert versions.published(spark, out) == second


def run_of(spark, out, version, value):
    run = versions.Run(spark, out, version)
    for name in tables.REPORT_TABLES:
        columns = tables.REPORT_COLUMNS.get(name, ("x",))
        df = spark.createDataFrame([(str(value),) * len(columns)], ", ".join(f"{c} string" for c in columns))
        run.table(name, lambda df=df: df, tables.write_table)
    run.publish(tables.REPORT_TABLES)


def test_a_new_version_is_seen_without_restart(spark, tmp_path):
    out = f"file:{tmp_path}/out"
    live = tables.LiveTables(spark, out)
    seen = []
    for value in (1, 2):
        run_of(spark, out, f"v{value}", value)
        now = live.now()
        assert live.now() is now
        seen.append((now["retail_cleaned"].first()["region"], now["retail_promo_lift"].first()["x"]))
        kept = now["retail_cleaned"]
        assert kept.storageLevel.useMemory
    assert seen == [("1", "1"), ("2", "2")]
    live.release()
    assert not kept.storageLevel.useMemory


def test_only_whole_sets_are_published_and_the_one_before_stays(spark, tmp_path):
    out = f"file:{tmp_path}/out"
    run = versions.Run(spark, out, "half")
    run.table("retail_promo_lift", lambda: spark.range(1), tables.write_table)
    with pytest.raises(ValueError, match="retail_cleaned"):
        run.publish(tables.REPORT_TABLES)
    assert versions.published(spark, out) is None
    for value in (1, 2, 3):
        run_of(spark, out, f"v{value}", value)
    assert set(versions.Files(spark).names(f"{out}/versions")) == {"v2", "v3"}
    # a reader that opened the version before can go on
    assert spark.read.parquet(f"{out}/versions/v2/retail_promo_lift").first()["x"] == "2"


def test_version_follows_inputs_and_settings(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x\n1\n")
    at = f"file:{folder}"
    first = versions.version_of(spark, [at], [1])
    assert first == versions.version_of(spark, [at], [1])
    assert first != versions.version_of(spark, [at], [2])
    (folder / "b.csv").write_text("x\n")
    assert first != versions.version_of(spark, [at], [1])


def test_a_folder_without_versions_is_read_as_it_is(spark, tmp_path):
    out = f"file:{tmp_path}/flat"
    tables.write_table(spark.range(3), out, "retail_promo_lift")
    assert tables.read_table(spark, out, "retail_promo_lift").count() == 3
