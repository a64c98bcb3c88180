"""What each file of a source folder has to have."""

from __future__ import annotations

import pytest

from conftest import audit, canon, frame, records
from deskspark.plans.entities import ENTITIES
from deskspark.sources.files import FileContract, FileSource, audit_files, columns_by_file, write_file

SPEC = ENTITIES["fila"]
FORMATS = ["parquet", "orc", "json", "csv"]


def queues(spark, *codes):
    return frame(spark, SPEC.source_schema, [{"id_fila": i, "cd_fila": c, "ds_descricao": None, **audit()} for i, c in enumerate(codes)])


def add(df, folder, fmt):
    write_file(df.coalesce(1), str(folder), fmt, mode="append")


def source(spark, tmp_path, fmt):
    return FileSource(spark, str(tmp_path), fmt)


@pytest.mark.parametrize("fmt", FORMATS)
def test_one_file_among_good_ones_lacks_a_column(spark, tmp_path, fmt):
    for code in "abc":
        add(queues(spark, code), tmp_path / "fila", fmt)
    assert source(spark, tmp_path, fmt)["fila"].count() == 3
    add(queues(spark, "d").drop("nm_fila"), tmp_path / "fila", fmt)
    with pytest.raises(FileContract, match="lacks the columns nm_fila"):
        source(spark, tmp_path, fmt)["fila"]
    assert audit_files(spark, str(tmp_path / "fila"), SPEC.source_schema, fmt).count() == 1
    assert columns_by_file(spark, str(tmp_path / "fila"), fmt).count() == 4


@pytest.mark.parametrize("fmt", FORMATS)
def test_a_renamed_column_is_missing(spark, tmp_path, fmt):
    add(queues(spark, "a"), tmp_path / "fila", fmt)
    add(queues(spark, "b").withColumnRenamed("ds_descricao", "ds_texto"), tmp_path / "fila", fmt)
    with pytest.raises(FileContract, match="ds_descricao"):
        source(spark, tmp_path, fmt)["fila"]


@pytest.mark.parametrize("fmt", FORMATS)
def test_columns_go_by_name_where_the_format_has_names(spark, tmp_path, fmt):
    good, turned = queues(spark, "a"), queues(spark, "b")
    add(good, tmp_path / "fila", fmt)
    add(turned.select(*reversed(turned.columns)), tmp_path / "fila", fmt)
    if fmt == "csv":
        with pytest.raises(FileContract, match="another order"):
            source(spark, tmp_path, fmt)["fila"]
    else:
        got = source(spark, tmp_path, fmt)["fila"]
        assert canon(records(got), SPEC.target_columns) == canon(records(good.union(turned)), SPEC.target_columns)


@pytest.mark.parametrize("fmt", FORMATS)
def test_more_columns_and_other_case(spark, tmp_path, fmt):
    wide = queues(spark, "a").withColumnRenamed("cd_fila", "CD_FILA").withColumnsRenamed({})
    add(wide if fmt == "csv" else wide.selectExpr("*", "1 AS extra"), tmp_path / "fila", fmt)
    if fmt == "json":  # field names of JSON are compared as they stand
        assert columns_by_file(spark, str(tmp_path / "fila"), fmt).first().found.count("CD_FILA") == 1
    else:
        assert [r.cd_fila for r in source(spark, tmp_path, fmt)["fila"].collect()] == ["a"]


@pytest.mark.parametrize("fmt", FORMATS)
def test_a_table_without_rows(spark, tmp_path, fmt):
    add(queues(spark), tmp_path / "fila", fmt)
    assert source(spark, tmp_path, fmt)["fila"].count() == 0


def test_paths_with_blanks_and_signs(spark, tmp_path):
    root = tmp_path / "a b%20c"
    add(queues(spark, "a"), root / "fila", "parquet")
    assert source(spark, root, "parquet")["fila"].count() == 1


def test_files_are_audited_once_and_again_when_asked(spark, tmp_path):
    add(queues(spark, "a"), tmp_path / "fila", "parquet")
    files = source(spark, tmp_path, "parquet")
    assert files["fila"].count() == 1
    add(queues(spark, "b").drop("nm_fila"), tmp_path / "fila", "parquet")
    files["fila"]
    with pytest.raises(FileContract):
        files.audit("fila")
