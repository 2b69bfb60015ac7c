"""Command-line steps over a literal case file in the source's own layout."""

import datetime
import json

import pytest
from oracle import canon

from epilake import cli
from epilake.plans import pipeline as pl
from epilake.session import scratch_path

CASES_CSV = """id_de_caso,fecha_reporte_web,departamento,departamento_nom,ciudad_municipio,edad,unidad_medida,sexo,estado,recuperado
1,2020-03-06 00:00:00,5,ANTIOQUIA,5001,30,1,F,Leve,Recuperado
2,2020-03-06 00:00:00,05,ANTIOQUIA,5001,45,1,M,Fallecido,Fallecido
3,2020-03-07 00:00:00,8,ATLANTICO,8001,,1,,Leve,Activo
4,6/3/2020 0:00:00,11,BOGOTA,11001,29.5,1,F,Leve,Recuperado
5,2020-03-08,99,OTRO,99001,70,1,M,Fallecido,Fallecido
"""

DIM_CSV = """codigo_departamento,departamento,poblacion
05,Antioquia,6677930
08,Atlántico,2722128
11,Bogotá D.C.,7743955
"""


def _write(spark, name, text):
    path = scratch_path(spark, name)
    spark.createDataFrame([(line,) for line in text.strip().split("\n")], "v string") \
        .coalesce(1).write.text(path)
    return path


def test_cli_source_layout_all_steps(spark):
    base = scratch_path(spark, "cli")
    cases = _write(spark, "raw", CASES_CSV)
    dim = _write(spark, "dim", DIM_CSV)
    res = cli.run(spark, ["all", "--cases", cases, "--dim", dim, "--base", base,
                          "--layout", "source", "--threshold", "2"])
    assert res.rows["trusted"] == 5
    trusted = {r.case_id: r for r in spark.read.parquet(res.paths["trusted"]).collect()}
    assert trusted["1"].dim_name == trusted["2"].dim_name == "Antioquia"   # '5' and '05' match
    assert trusted["4"].event_date is None                                 # unparseable date
    assert trusted["5"].dim_code is None                                   # unmatched code
    sex = {r.sex: (r.total_cases, r.deceased, r.recovered, r.fatality_pct)
           for r in spark.read.parquet(res.paths["outcomes_by_sex"]).collect()}
    assert sex == {"F": (2, 0, 2, 0.0), "M": (2, 2, 0, 100.0), "No reportado": (1, 0, 0, 0.0)}
    ages = {r.age_group: r.total_cases for r in spark.read.parquet(res.paths["age_distribution"]).collect()}
    assert ages == {"30-49 años": 2, "Desconocido": 1, "65+ años": 1}
    assert spark.read.parquet(res.paths["summary"]).count() == 4           # 3 dates + null date


def test_steps_one_by_one_equal_all(spark):
    cases, dim = _write(spark, "raw", CASES_CSV), _write(spark, "dim", DIM_CSV)
    a, b = scratch_path(spark, "cli_all"), scratch_path(spark, "cli_steps")
    common = ["--cases", cases, "--dim", dim, "--layout", "source"]
    all_res = cli.run(spark, ["all", "--base", a] + common)
    cli.run(spark, ["dimension", "--base", b, "--dim", dim])
    cli.run(spark, ["trusted", "--base", b, "--cases", cases, "--layout", "source"])
    cli.run(spark, ["refined", "--base", b, "--layout", "source"])
    cli.run(spark, ["summary", "--base", b])
    for name in ("indicators", "summary"):
        pa, pb = all_res.paths[name], pl.table_paths(b)[name]
        da, db = spark.read.parquet(pa), spark.read.parquet(pb)
        assert canon(da.columns, [tuple(r) for r in da.collect()]) == \
            canon(db.columns, [tuple(r) for r in db.collect()])


def test_cli_on_fixture_csv_equals_registered_queries(spark):
    # the sf0.001 fixture written as a landed CSV in the source's layout
    from pyspark.sql import functions as F

    from conftest import SF001
    from epilake import fixture as fx
    from epilake import queries as q
    cases = fx.cases(spark, SF001)
    landed = cases.select(
        F.col("case_id").alias("id_de_caso"),
        F.col("report_date").cast("string").alias("fecha_reporte_web"),
        F.col("region_raw").cast("string").alias("departamento"),
        F.col("region_name_raw").alias("departamento_nom"),
        F.col("age").alias("edad"), F.col("sex").alias("sexo"),
        F.when(F.col("status") == "Deceased", "Fallecido").otherwise("Leve").alias("estado"),
        F.when(F.col("status") == "Recovered", "Recuperado")
         .when(F.col("status") == "Deceased", "Fallecido").otherwise("Activo").alias("recuperado"))
    raw, dim, base = (scratch_path(spark, n) for n in ("raw_fx", "dim_fx", "cli_fx"))
    landed.write.option("header", True).csv(raw)
    fx.region_dim(spark, SF001).write.option("header", True).csv(dim)
    res = cli.run(spark, ["all", "--cases", raw, "--dim", dim, "--base", base, "--layout", "source"])

    def rows(df, cols):
        return canon(cols, [tuple(r) for r in df.select(*cols).collect()])

    ind_cols = ["date", "code", "name", "population", "new_cases", "cumulative_cases", "rate_per_100k"]
    assert rows(spark.read.parquet(res.paths["indicators"]), ind_cols) == rows(q.indicators(spark, SF001), ind_cols)
    sum_cols = ["date", "new_cases_national", "cumulative_cases_national", "population_total",
                "rate_per_100k_national", "latest_date"]
    assert rows(spark.read.parquet(res.paths["summary"]), sum_cols) == rows(q.summary(spark, SF001), sum_cols)
    from epilake.operators import analytics as an
    got = {r.sex: (r.total_cases, r.deceased, r.recovered)
           for r in spark.read.parquet(res.paths["outcomes_by_sex"]).collect()}
    want = {("No reportado" if r.sex == "Not reported" else r.sex): (r.total_cases, r.deceased, r.recovered)
            for r in an.outcome_breakdown(cases).collect()}
    assert got == want


def test_cli_source_names_serve_the_source_sql(spark):
    from epilake.sources import tables as tb
    cases, dim = _write(spark, "raw", CASES_CSV), _write(spark, "dim", DIM_CSV)
    base, canon_base = scratch_path(spark, "cli_names"), scratch_path(spark, "cli_canon")
    common = ["--cases", cases, "--dim", dim, "--layout", "source"]
    named = cli.run(spark, ["all", "--base", base, "--names", "source"] + common)
    plain = cli.run(spark, ["all", "--base", canon_base] + common)
    assert named.paths["summary"].endswith("refined/api_views/resumen_nacional_diario")
    assert spark.read.parquet(named.paths["trusted"]).filter("anio = 2020 AND mes = 3 AND dia = 6").count() == 2
    tb.register_lake_table(spark, "resumen_nacional_diario_t", named.paths["summary"])
    tb.register_lake_table(spark, "indicadores_departamento_t", named.paths["indicators"])
    # the serving read as the source writes it: string parts, padded month and day
    one = spark.sql("SELECT fecha, casos_nuevos_nacional, casos_acumulados_nacional "
                    "FROM resumen_nacional_diario_t WHERE anio = '2020' AND mes = '03' AND dia = '06' LIMIT 1").collect()
    assert [tuple(r) for r in one] == [(datetime.date(2020, 3, 6), 2, 2)]
    top = spark.sql("SELECT nombre_departamento, casos_por_100k FROM indicadores_departamento_t "
                    "WHERE anio = 2020 AND mes = 3 AND dia = 7 ORDER BY casos_por_100k DESC LIMIT 10").collect()
    assert [r.nombre_departamento for r in top] == ["Atlántico"]
    # same numbers as the canonical run, only the names differ
    for table in ("trusted", "indicators", "summary", "outcomes_by_sex", "moving_average"):
        a, b = spark.read.parquet(named.paths[table]), spark.read.parquet(plain.paths[table])
        names = cli.SOURCE_NAMES["columns"][table]
        b = b.withColumnsRenamed({c: n for c, n in names.items() if c in b.columns})
        cols = sorted(a.columns)
        if table == "trusted":  # columns the file lacks are null
            assert len(cols) == 30 and cols == sorted(cli.SOURCE_NAMES["trusted_columns"])
            lacking = [c for c in cols if c not in b.columns]
            assert a.filter(" OR ".join(f"{c} IS NOT NULL" for c in lacking)).count() == 0
            cols = [c for c in cols if c in b.columns]
        assert sorted(b.columns) == cols
        assert canon(cols, [tuple(r) for r in a.select(*cols).collect()]) == \
            canon(cols, [tuple(r) for r in b.select(*cols).collect()])


def test_cli_preview_prints_each_report(spark, capsys):
    cases, dim = _write(spark, "raw", CASES_CSV), _write(spark, "dim", DIM_CSV)
    cli.run(spark, ["all", "--base", scratch_path(spark, "cli_prev"), "--cases", cases, "--dim", dim,
                    "--layout", "source", "--preview", "3"])
    out = capsys.readouterr().out
    for name in cli.REPORT_ORDER:
        assert name in out
    assert "30-49 años" in out and "No reportado" in out


def test_cli_dimension_feeds_the_trusted_step(spark):
    cases, base = _write(spark, "raw", CASES_CSV), scratch_path(spark, "cli_dim")
    with pytest.raises(SystemExit, match="no dimension"):
        cli.run(spark, ["trusted", "--cases", cases, "--base", base, "--layout", "source"])
    out = scratch_path(spark, "dim_out")
    res = cli.run(spark, ["dimension", "--dim", _write(spark, "dim", DIM_CSV), "--base", base, "--dim-export", out])
    assert res.rows["dimension"] == 3 and spark.read.option("header", True).csv(out).count() == 3
    later = _write(spark, "dim", "c,n,p\n8,Barranquilla,5\n99,Otro,1")
    cli.run(spark, ["dimension", "--dim", later, "--base", base])
    res = cli.run(spark, ["trusted", "--cases", cases, "--base", base, "--layout", "source"])
    got = {r.case_id: (r.dim_code, r.dim_name) for r in spark.read.parquet(res.paths["trusted"]).collect()}
    assert got == {"1": ("05", "Antioquia"), "2": ("05", "Antioquia"), "3": ("08", "Barranquilla"),
                   "4": ("11", "Bogotá D.C."), "5": ("99", "Otro")}
    with pytest.raises(ValueError, match="population"):
        cli.run(spark, ["dimension", "--dim", _write(spark, "dim", "c,n,p\n11,X,many"), "--base", base])


def test_cli_prints_rejects_and_sets_records_apart(spark, capsys):
    cases, dim, base = _write(spark, "raw", CASES_CSV), _write(spark, "dim", DIM_CSV), scratch_path(spark, "cli_rej")
    cli.main(["all", "--cases", cases, "--dim", dim, "--base", base, "--layout", "source", "--quarantine",
              "--names", "source"])
    said = json.loads(capsys.readouterr().out.strip().split("\n")[-1])
    assert said["rejects"] == {"bad_dates": 1, "unmatched": 1, "bad_ages": 0, "malformed_lines": 0}
    assert said["rows"]["trusted"] == 4 and said["rows"]["rejected"] == 1 and said["rows"]["summary"] == 3
    trusted = spark.read.parquet(said["paths"]["trusted"])
    assert sorted(trusted.columns) == sorted([*cli.SOURCE_NAMES["trusted_columns"], "reject"])
    # reports have the source's columns
    assert spark.read.parquet(said["paths"]["top_regions_rate"]).columns == [
        "nombre_departamento", "tasa_por_100k", "casos_totales", "ultima_actualizacion"]
    assert spark.read.parquet(said["paths"]["threshold_dates"]).columns == [
        "nombre_departamento", "fecha_milestone_1000", "dias_desde_primer_caso"]
    cli.run(spark, ["refined", "--base", base, "--layout", "source", "--quarantine", "--names", "source", "--preview", "2"])
    assert "tasa_por_100k" in capsys.readouterr().out


def test_cli_registers_the_lake(spark, capsys):
    cases, dim, base = _write(spark, "raw", CASES_CSV), _write(spark, "dim", DIM_CSV), scratch_path(spark, "cli_reg")
    cli.run(spark, ["all", "--cases", cases, "--dim", dim, "--base", base, "--layout", "source"])
    db = "lake_" + base.rsplit("-", 1)[-1]
    res = cli.run(spark, ["register", "--base", base, "--database", db])
    assert {t.split(".")[1] for t in res.paths} >= {"cases", "region_indicators", "national_summary", "dimension",
                                                    "moving_average"}
    assert spark.table(f"{db}.cases").count() == 5 and spark.table(f"{db}.dimension").count() == 3
    assert spark.sql(f"SELECT sum(new_cases) FROM {db}.region_indicators WHERE year = 2020").first()[0] == 4
    cli.run(spark, ["dimension", "--dim", _write(spark, "dim", "c,n,p\n99,Otro,1"), "--base", base])
    cli.run(spark, ["register", "--base", base, "--database", db])
    assert spark.table(f"{db}.dimension").count() == 4 and "unchanged" in capsys.readouterr().out
