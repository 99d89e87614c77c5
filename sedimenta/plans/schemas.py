"""Fixed columns of the gold tables. A table is created with these and keeps them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DDL = {
    "dim_applicant": """
        applicant_sk STRING, applicant_id BIGINT, SK_ID_CURR BIGINT, name_income_type STRING,
        name_education_type STRING, name_family_status STRING, cnt_children INT, start_date TIMESTAMP_NTZ,
        end_date TIMESTAMP_NTZ, is_current BOOLEAN""",
    "dim_loan_type": "loan_type_id STRING, loan_type_name STRING",
    "dim_credit_status": "status_id STRING, status_code STRING, status_description STRING",
    "fact_loan_application": """
        fact_loan_application_sk BINARY, SK_ID_CURR BIGINT, applicant_id BIGINT, NAME_CONTRACT_TYPE STRING, TARGET INT,
        AMT_CREDIT DOUBLE, AMT_INCOME_TOTAL DOUBLE""",
    "fact_bureau_credit": """
        fact_bureau_credit_sk BINARY, SK_ID_BUREAU BIGINT, SK_ID_CURR BIGINT, CREDIT_DAY_OVERDUE INT,
        AMT_CREDIT_SUM DOUBLE, AMT_CREDIT_SUM_DEBT DOUBLE""",
    "fact_installment_payment": """
        fact_installment_payment_sk BINARY, SK_ID_PREV BIGINT, NUM_INSTALMENT_NUMBER INT, SK_ID_CURR BIGINT,
        AMT_INSTALMENT DOUBLE, AMT_PAYMENT DOUBLE""",
}


def gold_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[name])


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; a measure the source lacks is NULL.

    Hashed keys are hex text on the way and stored as their 32 bytes.
    """
    have = {c.lower(): df.schema[c].dataType for c in df.columns}

    def fitted(f: T.StructField):
        kind = have.get(f.name.lower())
        if isinstance(f.dataType, T.BinaryType) and isinstance(kind, T.StringType):
            return F.unhex(f.name).alias(f.name)
        return (F.col(f.name) if kind is not None else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*[fitted(f) for f in schema.fields])
