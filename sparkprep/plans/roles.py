"""Variable roles: which columns are numeric, ordinal, categorical or grouping."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions.scalar import col

# Named numeric columns and the number of scored questions per subject.
NUMERIC_NAMED = """
AGE COBN_S WB165 FL169 WB166 FL164 ST355 IC177 IC183 ST345 PA182 PA004 ST059
WB155 ST163 ST164 WB177 PA041 ST175 PA159 ST165 ST211 WB176 ST098 PA002
""".split()
QUESTIONS = {"reading": 15, "math": 21, "science": 19}
MEASURES = ["average_score", "total_timing"]

# Grouping columns and the text codes among them.
GROUPING = ["Year", "CNT", "CNTRYID", "CNTSCHID", "CNTSTUID", "STRATUM"]

# Ordinal and categorical columns handled by default.
ORDINAL = """
ST005 ST006 ST007 ST008 ST097 ST100 ST253 ST254 ST255 ST256 ST270 ST273 PA003 ST300
""".split()
CATEGORICAL = """
Option_CT Option_FL Option_ICTQ Option_PQ Option_TQ Option_UH Option_WBQ CYC NatCen SUBNATIO
LANGTEST_PAQ LANGTEST_COG LANGTEST_QQQ ST003D03T ST001D01T OCOD1 OCOD2 OCOD3 PA008 PA162
""".split()

# Columns dropped by default.
NUMERIC_CURATED = "PA159 IC183 ST163 FL164 WB177 PA041 ST164 ST165 ST211 PA182 ST175".split()
ORDINAL_REDUNDANT = "ST005 ST007 ST253 ST255 ST097".split()
METADATA = "Option_CT Option_FL Option_ICTQ Option_PQ Option_TQ Option_UH Option_WBQ CYC NatCen SUBNATIO".split()
CATEGORICAL_REDUNDANT = "LANGTEST_PAQ LANGTEST_QQQ ST003D03T ST001D01T PA008 PA162 OCOD3".split()

# Name prefixes of columns that leak the target.
LEAKAGE_PREFIXES = ["PV", "WLE"]

TARGET = "MathScore"
ROW_ID = "CNTSTUID"


def numeric_names() -> list[str]:
    """The named columns, then per measure the questions of each subject."""
    scored = [f"{s}_q{i}_{m}" for m in MEASURES for s, n in QUESTIONS.items() for i in range(1, n + 1)]
    return NUMERIC_NAMED + scored


@dataclass
class VariableRoles:
    numeric: list[str] = field(default_factory=numeric_names)
    grouping: list[str] = field(default_factory=lambda: list(GROUPING))
    ordinal: list[str] = field(default_factory=lambda: list(ORDINAL))
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "VariableRoles":
        return cls(**json.loads(text))

    @classmethod
    def from_df(cls, sheet: DataFrame, columns: dict[str, str]) -> "VariableRoles":
        """Roles from a sheet with one column per role; ``columns`` maps role to column.

        The sheet has one row per variable at most.
        """
        rows = role_rows(sheet, columns).collect()
        found: dict[str, list[str]] = {r: [] for r in ("numeric", "grouping", "ordinal", "categorical")}
        for r in rows:
            found[r.role].append(r.variable)
        return cls(**found)

    def rows(self, spark) -> DataFrame:
        """``(variable, role)``, one row per listed variable."""
        pairs = [(v, role) for role, names in asdict(self).items() for v in names]
        return spark.createDataFrame(pairs, "variable string, role string")


def role_rows(sheet: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``(role, variable)`` from a sheet whose columns list the variables of each role."""
    args = [a for role, c in columns.items() for a in (F.lit(role), F.trim(col(c)))]
    long = sheet.select(F.stack(F.lit(len(columns)), *args).alias("role", "variable"))
    return long.where(F.col("variable").isNotNull() & (F.col("variable") != ""))
