"""Command-line entry for ``spark-submit``: run one step or all of them.

    spark-submit epilake/cli.py all --cases RAW --dim DIM.csv --base OUT [options]
    spark-submit epilake/cli.py dimension --dim DIM.csv --base OUT
    spark-submit epilake/cli.py trusted --cases RAW --base OUT
    spark-submit epilake/cli.py refined --base OUT
    spark-submit epilake/cli.py summary --base OUT
    spark-submit epilake/cli.py register --base OUT --database DB

``dimension`` checks a dimension file against its contract and upserts it into
the dimension published under the base path, which ``trusted`` joins with; a
``--dim`` given to ``trusted`` or ``all`` is taken in first. ``register`` makes
catalog tables of all that is published, or follows what has changed.
``--layout source`` reads a case file with the public source's own column
names and outcome labels; ``--rename a=b`` adds or overrides renames.
``--names source`` publishes the refined tables under the folder and column
names the source's downstream queries use (all steps of one base path must
use the same ``--names``). The
session (master, memory, ``spark.checkpoint.dir``) comes from
``spark-submit``; nothing global is set here.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from epilake.functions.columns import AGE_BINS  # noqa: E402
from epilake.plans import pipeline as pl  # noqa: E402
from epilake.sources import crawl as cw  # noqa: E402
from epilake.sources import versions as vs  # noqa: E402

# Column names of the public case file and the labels its
# outcome columns are compared with (exact, case-sensitive).
SOURCE_LAYOUT = {
    "rename": {
        "id_de_caso": "case_id",
        "fecha_reporte_web": "report_date",
        "departamento": "region_raw",
        "departamento_nom": "region_name_raw",
        "edad": "age",
        "sexo": "sex",
    },
    "deceased_col": "estado",
    "deceased_value": "Fallecido",
    "recovered_col": "recuperado",
    "recovered_value": "Recuperado",
    "missing_label": "No reportado",
    "age_labels": ("0-17 años", "18-29 años", "30-49 años", "50-64 años", "65+ años"),
    "age_fallback": "Desconocido",
}

# Folder and column names of the published tables as the
# source's downstream queries know them (table -> folder, table -> columns;
# None: not published).
SOURCE_NAMES = {
    "folders": {
        "trusted": "trusted/covid",
        "indicators": "refined/indicadores_departamento",
        "summary": "refined/api_views/resumen_nacional_diario",
        "top_regions_rate": "top_departamentos_tasa",
        "monthly_trends": "tendencias_mensuales",
        "age_distribution": "distribucion_edad",
        "outcomes_by_sex": "desglose_genero",
        "threshold_dates": "hitos_1000_casos",
        "moving_average": "promedio_movil_7dias",
    },
    "columns": {
        "trusted": {
            "case_id": "id_de_caso", "report_date": "fecha_reporte_web",
            "event_date": "fecha_reporte_web_date", "year": "anio", "month": "mes", "day": "dia",
            "region_raw": "codigo_divipola_departamento", "region_name_raw": "departamento_nom",
            "ciudad_municipio": "codigo_divipola_municipio", "ciudad_municipio_nom": "nombre_municipio",
            "age": "edad", "sex": "sexo", "dim_code": "codigo_departamento",
            "dim_name": "departamento_nombre_normalizado", "population": "poblacion",
        },
        "indicators": {
            "date": "fecha", "year": "anio", "month": "mes", "day": "dia",
            "code": "codigo_departamento", "name": "nombre_departamento",
            "population": "poblacion", "new_cases": "casos_nuevos",
            "cumulative_cases": "casos_acumulados", "rate_per_100k": "casos_por_100k",
        },
        "summary": {
            "date": "fecha", "year": "anio", "month": "mes", "day": "dia",
            "new_cases_national": "casos_nuevos_nacional",
            "cumulative_cases_national": "casos_acumulados_nacional",
            "population_total": "poblacion_total_aprox",
            "rate_per_100k_national": "casos_por_100k_nacional",
            "latest_date": "ultima_fecha_disponible",
        },
        "top_regions_rate": {
            "code": None, "name": "nombre_departamento",
            "rate_per_100k": "tasa_por_100k", "total_cases": "casos_totales",
            "last_date": "ultima_actualizacion",
        },
        "monthly_trends": {
            "year": "anio", "month": "mes", "monthly_cases": "casos_mensuales",
            "regions_reporting": "departamentos_afectados", "avg_daily_cases": "promedio_diario",
        },
        "age_distribution": {
            "age_group": "grupo_edad", "total_cases": "total_casos", "share_pct": "porcentaje",
        },
        "outcomes_by_sex": {
            "sex": "sexo", "total_cases": "total_casos", "deceased": "fallecidos",
            "recovered": "recuperados", "fatality_pct": "tasa_letalidad",
        },
        "threshold_dates": {
            "code": None, "name": "nombre_departamento",
            "first_date": "fecha_milestone_1000", "days_since_origin": "dias_desde_primer_caso",
        },
        "moving_average": {
            "date": "fecha", "new_cases_national": "casos_nuevos_nacional",
            "moving_avg": "promedio_movil_7dias",
        },
    },
    # fixed values: the trusted table's columns in order
    "trusted_columns": (
        "id_de_caso", "fecha_reporte_web", "fecha_reporte_web_date", "fecha_de_notificaci_n",
        "anio", "mes", "dia", "codigo_divipola_departamento", "departamento_nom",
        "codigo_divipola_municipio", "nombre_municipio", "edad", "unidad_medida", "sexo",
        "fuente_tipo_contagio", "ubicacion", "estado", "pais_viajo_1_cod", "pais_viajo_1_nom",
        "recuperado", "fecha_inicio_sintomas", "fecha_muerte", "fecha_diagnostico",
        "fecha_recuperado", "tipo_recuperacion", "per_etn_", "nom_grupo_", "codigo_departamento",
        "departamento_nombre_normalizado", "poblacion",
    ),
}

STEPS = ("dimension", "trusted", "refined", "summary", "register", "all")


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="epilake", description=__doc__.split("\n")[0])
    p.add_argument("step", choices=STEPS)
    p.add_argument("--cases", help="landed raw case records (folder or file)")
    p.add_argument("--cases-format", default="csv")
    p.add_argument("--dim", help="dimension CSV: code, name, population (header row)")
    p.add_argument("--base", required=True, help="root folder of the published tables")
    p.add_argument("--layout", choices=("canonical", "source"), default="canonical")
    p.add_argument("--rename", action="append", default=[], metavar="FROM=TO")
    p.add_argument("--names", choices=("canonical", "source"), default="canonical",
                   help="folder and column names of the published tables")
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--threshold", type=int, default=1000)
    p.add_argument("--origin", default="2020-03-06")
    p.add_argument("--moving-window", type=int, default=7)
    p.add_argument("--no-analytics", action="store_true")
    p.add_argument("--dynamic-overwrite", action="store_true")
    p.add_argument("--densify", action="store_true")
    p.add_argument("--preview", type=int, default=0, metavar="N",
                   help="print the first N rows of each report written")
    p.add_argument("--quarantine", action="store_true",
                   help="write records that can't be used apart from the trusted table")
    p.add_argument("--dim-export", metavar="PATH", help="also export the dimension")
    p.add_argument("--dim-export-format", default="csv")
    p.add_argument("--database", help="catalog database of the step register")
    args = p.parse_args(argv)
    if args.step in ("trusted", "all") and not args.cases:
        p.error(f"step {args.step!r} needs --cases")
    if args.step == "dimension" and not args.dim:
        p.error("step 'dimension' needs --dim")
    return args


def config_from(args: argparse.Namespace) -> tuple[pl.PipelineConfig, dict[str, str]]:
    rename: dict[str, str] = {}
    labels: dict[str, str] = {}
    if args.layout == "source":
        rename.update(SOURCE_LAYOUT["rename"])
        labels = {k: v for k, v in SOURCE_LAYOUT.items() if k not in ("rename", "age_labels")}
        labels["age_bins"] = tuple((label, lo, hi) for label, (_, lo, hi)
                                   in zip(SOURCE_LAYOUT["age_labels"], AGE_BINS))
    for item in args.rename:
        src, _, dst = item.partition("=")
        if not src or not dst:
            raise SystemExit(f"bad --rename {item!r}, expected FROM=TO")
        rename[src] = dst
    cfg = pl.PipelineConfig(k=args.k, threshold=args.threshold, origin=args.origin,
                            moving_window=args.moving_window,
                            run_analytics=not args.no_analytics,
                            dynamic_overwrite=args.dynamic_overwrite, densify=args.densify,
                            quarantine=args.quarantine,
                            **labels, **(SOURCE_NAMES if args.names == "source" else {}))
    return cfg, rename


def run(spark: SparkSession, argv: list[str]) -> pl.PipelineResult:
    args = parse_args(argv)
    cfg, rename = config_from(args)
    res = pl.PipelineResult()
    dimension = f"{args.base.rstrip('/')}/{pl.DIMENSION}"
    if args.dim and args.step in ("dimension", "trusted", "all"):
        commit, report = pl.ingest_dimension(spark, args.dim, dimension, args.dim_export, args.dim_export_format)
        res.paths["dimension"], res.rows["dimension"] = dimension, report.first()["rows"]
    if args.step in ("trusted", "all"):
        if pl.DIMENSION not in vs.latest(spark, dimension).tables:
            raise SystemExit(f"no dimension is published under {args.base}; run the step dimension or give --dim")
        cases = pl.read_landed_cases(spark, args.cases, rename, fmt=args.cases_format, keep_text=True)
        pl.step_trusted(spark, cases, pl.read_dimension(spark, dimension), args.base, cfg, res)
    if args.step in ("refined", "all"):
        pl.step_refined(spark, args.base, cfg, res)
    if args.step in ("summary", "all"):
        pl.step_summary(spark, args.base, cfg, res)
    if args.step == "register":
        report = cw.crawl(spark, args.base, args.database).collect()
        for r in report:
            res.paths[r["table"]] = r["root"]
            print(f"{r['table']}: {r['action']}, {r['partitions_added']} partitions added, "
                  f"{r['partitions_dropped']} dropped, columns added: {', '.join(r['columns_added']) or 'none'}")
        if pl.DIMENSION in vs.latest(spark, dimension).tables:
            name = f"{args.database}.{pl.DIMENSION}" if args.database else pl.DIMENSION
            vs.point_view(spark, name, dimension, pl.DIMENSION)
            res.paths[name] = dimension
    if args.preview > 0:
        for name in REPORT_ORDER:
            if name in res.paths:
                print(f"{name} ({res.paths[name]})")
                preview(spark, res.paths[name], name, args.preview).show(args.preview, truncate=False)
    return res


#: Reports in the order the refined step writes them, and the order their
#: rows are shown in (published names are mapped back before ordering).
REPORT_ORDER = ("top_regions_rate", "monthly_trends", "age_distribution", "outcomes_by_sex",
                "threshold_dates", "moving_average")


def preview(spark: SparkSession, path: str, name: str, n: int):
    """First ``n`` rows of a written report in its natural order (reports
    are bounded: one row per region, month, bin, label or date)."""
    from pyspark.sql import functions as F
    df = spark.read.parquet(path)
    order = {"top_regions_rate": [F.col(df.columns[-3]).desc_nulls_last(), F.col(df.columns[0])],
             "monthly_trends": [F.col(df.columns[0]), F.col(df.columns[1])],
             "age_distribution": [F.col(df.columns[1]).desc()],
             "outcomes_by_sex": [F.col(df.columns[1]).desc()],
             "threshold_dates": [F.col(df.columns[-2])],
             "moving_average": [F.col(df.columns[0]).desc()]}[name]
    return df.orderBy(*order).limit(n)


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    parse_args(argv)  # usage errors before any JVM starts
    spark = SparkSession.builder.appName("epilake").getOrCreate()
    res = run(spark, argv)
    print(json.dumps({"paths": res.paths, "rows": res.rows, "rejects": res.rejects}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
