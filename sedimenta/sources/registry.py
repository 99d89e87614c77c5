"""One entry per source table: file, layer names, grain, casts and masking.

Everything that runs "for each table" is driven by this registry, so a new
table is one more entry and no code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Names, grains and casts of the seven source tables.
SENTINEL_DAYS_EMPLOYED = 365243
SENTINEL_ORGANIZATION = "XNA"
INGESTION_TS = "ingestion_ts"
INGESTION_DATE = "ingestion_date"


@dataclass(frozen=True)
class TableSpec:
    source: str
    silver: str
    keys: tuple[str, ...]
    casts: dict[str, str] = field(default_factory=dict)
    sentinels: dict[str, object] = field(default_factory=dict)
    masked: tuple[str, ...] = ()
    versioned: bool = False
    parent: tuple[str, str] | None = None  # (silver table, shared key)
    trend: tuple[str, ...] = ()  # columns whose changes keep a trend up to date
    rules: dict[str, tuple[str, str]] = field(default_factory=dict)  # rule -> (column, predicate of a BAD row)

    @property
    def file_name(self) -> str:
        return f"{self.source}.csv"

    @property
    def bronze(self) -> str:
        return f"bronze_{self.source.lower()}"

    @property
    def quarantine(self) -> str:
        return f"quarantine_{self.silver.removeprefix('silver_')}"


MONEY = "double"

TABLES: dict[str, TableSpec] = {
    spec.source: spec
    for spec in (
        TableSpec(
            source="application_train",
            silver="silver_application",
            keys=("SK_ID_CURR",),
            casts={"DAYS_BIRTH": "int", "DAYS_EMPLOYED": "int", "AMT_CREDIT": MONEY, "TARGET": "int",
                   "AMT_INCOME_TOTAL": MONEY, "CNT_CHILDREN": "int"},
            sentinels={"DAYS_EMPLOYED": SENTINEL_DAYS_EMPLOYED, "ORGANIZATION_TYPE": SENTINEL_ORGANIZATION},
            masked=("DAYS_BIRTH", "DAYS_EMPLOYED"),
            versioned=True,
            rules={
                "target_missing": ("TARGET", "TARGET IS NULL"),
                "target_domain": ("TARGET", "TARGET NOT IN (0, 1)"),
                "credit_not_positive": ("AMT_CREDIT", "AMT_CREDIT IS NULL OR AMT_CREDIT <= 0"),
            },
        ),
        TableSpec(
            source="bureau",
            silver="silver_bureau",
            keys=("SK_ID_BUREAU",),
            casts={"DAYS_CREDIT": "int", "AMT_CREDIT_SUM": MONEY, "AMT_CREDIT_SUM_DEBT": MONEY,
                   "CREDIT_DAY_OVERDUE": "int"},
            parent=("silver_application", "SK_ID_CURR"),
        ),
        TableSpec(
            source="bureau_balance",
            silver="silver_bureau_balance",
            keys=("SK_ID_BUREAU", "MONTHS_BALANCE"),
            casts={"MONTHS_BALANCE": "int"},
        ),
        TableSpec(
            source="previous_application",
            silver="silver_previous_application",
            keys=("SK_ID_PREV",),
            casts={"AMT_CREDIT": MONEY, "DAYS_DECISION": "int"},
        ),
        TableSpec(
            source="installments_payments",
            silver="silver_installments_payments",
            keys=("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"),
            casts={"NUM_INSTALMENT_NUMBER": "int", "AMT_INSTALMENT": MONEY, "AMT_PAYMENT": MONEY},
        ),
        TableSpec(
            source="POS_CASH_balance",
            silver="silver_pos_cash_balance",
            keys=("SK_ID_PREV", "MONTHS_BALANCE"),
            casts={"MONTHS_BALANCE": "int"},
            trend=("MONTHS_BALANCE", "SK_DPD"),
        ),
        TableSpec(
            source="credit_card_balance",
            silver="silver_credit_card_balance",
            keys=("SK_ID_PREV", "MONTHS_BALANCE"),
            casts={"MONTHS_BALANCE": "int"},
            trend=("MONTHS_BALANCE", "AMT_BALANCE"),
        ),
    )
}

# Columns whose type is known before a file is opened. Key columns are BIGINT
# unless a cast above says otherwise; a column not named here has the type of its
# prefix, any other arrives as text.
KEY_TYPE = "bigint"
# Amounts and counts (written with a decimal point in some tables), days past due.
TYPES_BY_PREFIX = {"AMT_": MONEY, "CNT_": MONEY, "SK_DPD": "int"}


def declared_types(spec: TableSpec) -> dict[str, str]:
    keys = {key: KEY_TYPE for key in (*spec.keys, "SK_ID_CURR", "SK_ID_PREV", "SK_ID_BUREAU")}
    return {**keys, **spec.casts}
