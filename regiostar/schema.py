"""Fixed values of the data contract: names, types, lengths, allowed values and bounds."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    """One cohort column: its name in the source file, in the tables, its type and length limit."""

    source: str
    name: str
    type: str
    max_length: int | None = None
    required: bool = True


@dataclass(frozen=True)
class Dimension:
    table: str
    key: str
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


# The cohort file's headers (spelling as delivered) and the table columns they feed.
PERIOD = Dimension(
    "dim_period",
    "sk_period",
    (
        Field("VIGENCIA", "vigencia", "int"),
        Field("PERIODO OTORGAMIENTO", "periodo_otorgamiento", "string", 10),
    ),
)
GEOGRAPHY = Dimension(
    "dim_geography",
    "sk_geography",
    (
        Field("CÓDIGO DEDEPARTAMENTO DE ORIGEN", "codigo_departamento", "int"),
        Field("DEPARTAMENTO DE ORIGEN", "departamento", "string", 100),
        Field("CATEGORÍA DEL MUNICIPIO DE ORIGEN", "categoria_municipio", "string", 100),
    ),
)
PROGRAM = Dimension(
    "dim_program",
    "sk_program",
    (
        Field("SECTOR IES", "sector_ies", "string", 50, required=False),
        Field("NIVEL DE FORMACIÓN", "nivel_formacion", "string", 100),
        Field("MODALIDAD DE LÍNEA", "modalidad_linea", "string", 100),
        Field("MODALIDAD DEL CRÉDITO", "modalidad_credito", "string", 100),
    ),
)
STUDENT = Dimension(
    "dim_student_profile",
    "sk_student_profile",
    (
        Field("SEXO AL NACER", "sexo_al_nacer", "string", 20),
        Field("ESTRATO SOCIOECONÓMICO", "estrato_socioeconomico", "int"),
    ),
)
DIMENSIONS = (PERIOD, GEOGRAPHY, PROGRAM, STUDENT)

FACT_TABLE = "fact_credits"
FACT_FIELDS = (
    Field("RANGO DEL VALOR TOTAL DESEMBOLSADO", "rango_valor_desembolsado", "string", 10),
    Field("NÚMERO DE NUEVOS BENEFICIARIOS DE CRÉDITO", "total_nuevos_beneficiarios", "int"),
)

COHORT_FIELDS = tuple(f for d in DIMENSIONS for f in d.fields) + FACT_FIELDS
SURROGATE_KEYS = [d.key for d in DIMENSIONS]

YEAR = "vigencia"
REGION = "departamento"
SECTOR = "sector_ies"
STRATUM = "estrato_socioeconomico"
MEASURE = "total_nuevos_beneficiarios"
NO_SECTOR = "NO CLASIFICADO"

# Macro records. Aliases are tried in the order given.
MACRO_YEAR = "a_o"
MACRO_REGION = "departamento"
MACRO_MIN_YEAR = 2018
MACRO_VALUE = "pib_miles_millones"
MACRO_VALUE_TYPE = "decimal(15,4)"
MACRO_ALIASES = {MACRO_VALUE: ("valor_miles_de_millones_de",)}
MACRO_RECORD_COLUMNS = (
    "a_o",
    "departamento",
    "actividad",
    "sector",
    "tipo_de_precios",
    "c_digo_departamento_divipola",
    "valor_miles_de_millones_de",
)
PAGE_SIZE = 50_000
MATCH_THRESHOLD = 85.0

# Candidate names of the geographic column, in order of preference.
GEO_CANDIDATES = ("departamento", "nombre_departamento", "municipio", "nombre_municipio", "dp")
# Words in a column name that hint at dates.
DATE_WORDS = ("fecha", "periodo", "date", "mes_a_o", "mes")
NUMERIC_SHARE = 0.90
CATEGORY_SHARE = 0.50

# Mart filters and quality limits.
TARGET_STRATA = (1, 2, 3)
TARGET_SECTORS = ("OFICIAL", "PRIVADO", "PRIVADA")
ALLOWED_SECTORS = ("OFICIAL", "PRIVADA", "PRIVADO", "NO CLASIFICADO")
ALLOWED_STRATA = (1, 2, 3, 4, 5, 6)
STRATUM_TOLERANCE = 0.95
MIN_ROWS = 50_000
MAX_ROWS = 150_000
NULL_WARNING_PERCENT = 5.0

# Texts a CSV reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
