import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from regiostar.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # The tables are tiny, so compiling each plan would take longer than interpreting it.
    quick = {
        "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
    }
    session = build_session("local[8]", 2, **{"spark.driver.memory": "4g", **quick})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows as a DataFrame: ``table("a int, b string", (1, "x"), ...)``."""

    def make(columns, *rows):
        return spark.createDataFrame([tuple(r) for r in rows], columns)

    return make


@pytest.fixture
def rows():
    def collect(df, *order):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=repr) if not order else found

    return collect


COHORT = (
    "vigencia int, periodo_otorgamiento string, codigo_departamento int, departamento string, "
    "categoria_municipio string, sector_ies string, nivel_formacion string, modalidad_linea string, "
    "modalidad_credito string, sexo_al_nacer string, estrato_socioeconomico int, rango_valor_desembolsado string, "
    "total_nuevos_beneficiarios int"
)


@pytest.fixture
def cohort(spark):
    """Cohort rows from (year, region code, sector, stratum, measure); the other columns are constant."""

    def make(*items):
        rows = [
            (year, "S1", code, None if code is None else f"REGION {code}", "CAT", sector, "N", "L", "C", "F", stratum, "BAJO", n)
            for year, code, sector, stratum, n in items
        ]
        return spark.createDataFrame(rows, COHORT)

    return make
