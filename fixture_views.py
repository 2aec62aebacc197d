"""The given tables seen as warehouse views.

``Analogue`` renames them as they are: customers are patients, line items are
procedures, diagnoses and medication orders, parts are the code dimensions.

``CLINICAL`` derives views that carry real codes and drug names: each part gets
an entry of a code list by its key. These are SQL texts that Spark and DuckDB
both run, so that both sides of a check start from the same input.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.index import NO_ENCOUNTER
from cohortloom.sources import Warehouse, load
from oracle_values import CONDITION_CODES, DRUG_PATTERNS, SURGERY_CODES

BASE_TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load(spark, folder, name, BASE_TABLES[name])


def case_key() -> Column:
    """Text key of a line item; with the ship date it is unique."""
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat_ws("-", *[F.col(c).cast("string") for c in parts])


@dataclass(frozen=True)
class Analogue:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return base_table(self.spark, self.folder, name)

    @cached_property
    def items(self) -> DataFrame:
        """Line items with their order. Everything computed is computed below the
        join, so that filters and semi-joins on the result reach the tables."""
        items = self.table("lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_shipdate",
            case_key().alias("case_key"),
            F.col("l_shipdate").cast("date").alias("ship_day"),
        )
        status = F.col("o_orderstatus")
        orders = self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderdate",
            F.substring("o_orderpriority", 1, 1).cast("long").alias("priority_key"),
            F.ascii(status).cast("long").alias("status_key"),
            F.when(status == "P", NO_ENCOUNTER)
            .otherwise(F.col("o_orderkey"))
            .alias("encounter_key"),
        )
        return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @property
    def procedure_dim(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("procedure_key"),
            F.col("p_name").alias("procedure_name"),
            F.col("p_type").alias("code_type"),
            F.col("p_brand").alias("procedure_code"),
        )

    @property
    def procedures(self) -> DataFrame:
        return self.items.select(
            F.col("case_key").alias("coded_procedure_key"),
            F.col("o_custkey").alias("patient_key"),
            F.col("l_partkey").alias("procedure_key"),
            F.col("l_orderkey").alias("visit_key"),
            F.col("encounter_key").alias("encounter_inpatient_key"),
            F.col("ship_day").alias("coded_procedure_date_key"),
        )

    @property
    def encounters(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("encounter_inpatient_key"),
            F.col("o_orderdate").alias("discharge_datetime"),
        )

    @property
    def patients(self) -> DataFrame:
        nation = self.table("nation")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("ir_id"),
                F.col("c_custkey").alias("patient_key"),
                F.lit(None).cast("date").alias("birth_date"),
                F.col("c_mktsegment").alias("race_1"),
                F.col("n_name").alias("gender"),
                F.lit(None).cast("date").alias("death_date"),
            )
        )

    @property
    def patients_with_birth(self) -> DataFrame:
        """The first order stands for the birth."""
        born = self.table("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("born"))
        return (
            self.patients.join(born, F.col("patient_key") == F.col("o_custkey"), "left")
            .withColumn("birth_date", F.col("born").cast("date"))
            .drop("o_custkey", "born")
        )

    @property
    def diagnoses(self) -> DataFrame:
        return self.items.select(
            F.col("case_key").alias("diagnosis_event_key"),
            F.col("o_custkey").alias("patient_key"),
            F.col("l_partkey").alias("diagnosis_key"),
            F.col("priority_key").alias("diagnosis_event_profile_key"),
            F.col("l_shipdate").alias("start_datetime"),
            F.col("ship_day").alias("start_date_key"),
        )

    @property
    def profile(self) -> DataFrame:
        return (
            self.table("orders")
            .select(
                F.substring("o_orderpriority", 1, 1).cast("long").alias("diagnosis_event_profile_key"),
                F.col("o_orderpriority").alias("load_type"),
            )
            .distinct()
        )

    @property
    def terminology(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("diagnosis_key"),
            F.col("p_type").alias("diagnosis_code_set"),
            F.col("p_brand").alias("diagnosis_code"),
            F.col("p_brand").alias("diagnosis_code_base"),
            F.col("p_name").alias("diagnosis_name"),
        )

    @property
    def medications(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("medication_key"),
            F.col("p_name").alias("medication_name"),
            F.col("p_type").alias("generic_name"),
        )

    @property
    def medication_orders(self) -> DataFrame:
        return self.items.select(
            F.col("l_partkey").alias("medication_key"),
            F.col("o_custkey").alias("patient_key"),
            F.col("status_key").alias("medication_order_profile_key"),
            F.col("o_orderdate").alias("order_placed_datetime"),
            F.col("l_shipdate").alias("order_start_datetime"),
            F.lit(None).cast("timestamp_ntz").alias("order_end_datetime"),
        )

    @property
    def order_profile(self) -> DataFrame:
        return (
            self.table("orders")
            .select(
                F.ascii("o_orderstatus").cast("long").alias("medication_order_profile_key"),
                F.col("o_orderstatus").alias("order_status"),
            )
            .distinct()
        )


def _quoted(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    """A VALUES list whose first column is the row's slot number."""
    return ", ".join(
        "(" + ", ".join(_quoted(v) for v in (slot, *row)) + ")" for slot, row in enumerate(rows)
    )


def procedure_entries() -> list[tuple]:
    """(code type, code, name): every surgery code, and some that do not count."""
    systems = {5: "CPT", 7: "ICD10"}
    listed = [
        ("ICD9" if "." in code else systems[len(code)], code, f"Bypass {n} at 50% o'clock")
        for n, code in enumerate(SURGERY_CODES)
    ]
    other = [
        ("CPT", "33515", "Not a bypass"),
        ("HCPCS", "33510", "Code in another system"),
        ("ICD10", "02100ZW", "Not a code"),
        ("ICD9", "36.18", "Not a code"),
    ]
    return listed + other * 60


def term_entries() -> list[tuple]:
    """(code set, code, base, name) around every criterion of every condition."""
    rows = []
    for _, system, kind, codes in CONDITION_CODES:
        for code_set in (system or "ICD-9-CM", "LOCAL"):
            for code in codes:
                if kind == "code":
                    rows.append((code_set, code, code.split(".")[0], "Entry"))
                else:
                    rows.append((code_set, f"{code}.7", code, None))
    rows += [
        ("ICD-9-CM", "4011", "4011", "Inside a text range"),
        ("ICD-9-CM", "405.1", "405.1", "Above a text range"),
        ("ICD-10-CM", "I15.9", "I15.9", "Inside a text range"),
        ("ICD-10-CM", "I16.0", "I16.0", "Above a text range"),
        ("ICD-10-CM", "I48.0", "I48", "Family of a code"),
        ("ICD-10-CM", "F17.210", "F17", "Prefix of a code"),
        ("ICD-10-CM", "F17.3", "F17", None),
        ("SNOMED", "1", "1", "Diabetes type 2, mellitus"),
        ("SNOMED", "2", "2", "diabetes mellitus"),
        ("SNOMED", "3", "3", "mellitus diabetes"),
        ("SNOMED", "4", "4", "Smoker"),
        ("SNOMED", "5", "5", "uses cigars"),
        (None, None, None, "no code at all, smoked"),
        (None, None, None, None),
    ]
    return rows + [("ICD-10-CM", f"Z{n}", "Z", f"Other {n}") for n in range(100)]


def drug_entries() -> list[tuple]:
    """(brand, generic): a name for every pattern, near misses, and other drugs."""
    rows = []
    for _, *lists in DRUG_PATTERNS:
        named = [(column, p) for column, patterns in enumerate(lists) for p in patterns]
        for n, (column, pattern) in enumerate(named):
            name = pattern.strip("%").replace("%", " x ")
            name = ("Oral " if pattern.startswith("%") else "") + name
            name += " 10 MG" if pattern.endswith("%") else ""
            name = (name, name.upper(), name.lower())[n % 3]
            other = None if n % 2 else "unlisted"
            rows.append((other, name) if column else (name, other))
    rows += [
        ("Hemangeol 4 MG", None),
        (None, "Doxazosin mesylate"),
        ("simvastatin 20 MG", "simvastatin"),
        (None, "simvastatin"),
        ("Exforge", "Amlodipine / valsartan"),
        ("Tarka", "trandolapril / Verapamil"),
        ("Plendil", "Felodipine / Metoprolol"),
        ("Bufferin", "Aspirin / magnesium oxide"),
        ("Lopressor HCT", "Metoprolol / Hydrochlorothiazide"),
    ]
    return rows + [(f"Other {n}", f"other {n}") for n in range(50)]


# A line item's event is undated when its number is 7 and its order is divisible by 5.
_DATE = "CASE WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END"
_CASE = "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"


def clinical_sql() -> dict[str, str]:
    """SQL of each view over the given tables, with ``{table}`` placeholders."""
    procedures, terms, medicines = procedure_entries(), term_entries(), drug_entries()
    # Two patient keys share a person, and every 97th patient has no person id.
    person = "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey + c_custkey % 2 END"
    return {
        "patient": f"""
            SELECT c_custkey AS patient_key, {person} AS ir_id,
                   DATE '1930-01-01' + CAST((c_custkey * 37) % 25000 AS INT) AS birth_date,
                   c_mktsegment AS race_1,
                   CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                   CAST(NULL AS DATE) AS death_date
            FROM {{customer}}""",
        "patient_current": f"""
            SELECT {person} AS ir_id, c_custkey AS patient_key
            FROM {{customer}} WHERE c_custkey % 10 <> 3""",
        "procedure": f"""
            SELECT p_partkey AS procedure_key, name AS procedure_name, code_type,
                   code AS procedure_code
            FROM {{part}} JOIN (VALUES {values(procedures)}) AS t(slot, code_type, code, name)
            ON p_partkey % {len(procedures)} = slot""",
        "coded_procedure": f"""
            SELECT case_key AS coded_procedure_key, o_custkey AS patient_key,
                   l_partkey AS procedure_key, l_orderkey AS visit_key,
                   encounter_key AS encounter_inpatient_key, day AS coded_procedure_date_key
            FROM (SELECT l_orderkey, l_partkey, {_CASE} AS case_key, {_DATE} AS day
                  FROM {{lineitem}}) AS i
            JOIN (SELECT o_orderkey, o_custkey,
                         CASE WHEN o_orderstatus = 'P' THEN -2 ELSE o_orderkey END AS encounter_key
                  FROM {{orders}}) AS o ON l_orderkey = o_orderkey""",
        "encounter_inpatient": """
            SELECT CASE WHEN o_orderkey % 1000 = 7 THEN -2 ELSE o_orderkey END
                       AS encounter_inpatient_key,
                   o_orderdate + INTERVAL '400' DAY AS discharge_datetime
            FROM {orders}""",
        "diagnosis_event": f"""
            SELECT case_key AS diagnosis_event_key, o_custkey AS patient_key,
                   l_partkey AS diagnosis_key, profile AS diagnosis_event_profile_key,
                   moment AS start_datetime, day AS start_date_key
            FROM (SELECT l_orderkey, l_partkey, {_CASE} AS case_key, {_DATE} AS day,
                         CASE WHEN l_linenumber = 6 THEN NULL ELSE l_shipdate END AS moment
                  FROM {{lineitem}}) AS i
            JOIN (SELECT o_orderkey, o_custkey,
                         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS profile
                  FROM {{orders}}) AS o ON l_orderkey = o_orderkey""",
        "diagnosis_event_profile": """
            SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT)
                       AS diagnosis_event_profile_key,
                   CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Encounter Diagnosis'
                        WHEN '2' THEN 'Problem List' WHEN '3' THEN 'Billing Diagnosis'
                        ELSE 'Medical History' END AS load_type
            FROM {orders}""",
        "diagnosis_terminology": f"""
            SELECT p_partkey AS diagnosis_key, code_set AS diagnosis_code_set,
                   code AS diagnosis_code, base AS diagnosis_code_base, name AS diagnosis_name
            FROM {{part}} JOIN (VALUES {values(terms)}) AS t(slot, code_set, code, base, name)
            ON p_partkey % {len(terms)} = slot""",
        "medication": f"""
            SELECT CASE WHEN p_partkey % 50 = 49 THEN -p_partkey ELSE p_partkey END
                       AS medication_key,
                   brand AS medication_name, generic AS generic_name
            FROM {{part}} JOIN (VALUES {values(medicines)}) AS t(slot, brand, generic)
            ON p_partkey % {len(medicines)} = slot""",
        "medication_order": """
            SELECT medication AS medication_key, o_custkey AS patient_key,
                   status AS medication_order_profile_key,
                   o_orderdate AS order_placed_datetime, l_shipdate AS order_start_datetime,
                   ended AS order_end_datetime
            FROM (SELECT l_orderkey, l_shipdate,
                         CASE WHEN l_partkey % 50 = 49 THEN -l_partkey ELSE l_partkey END AS medication,
                         CASE WHEN l_linenumber < 5 THEN l_shipdate END AS ended
                  FROM {lineitem}) AS i
            JOIN (SELECT o_orderkey, o_custkey, o_orderdate,
                         CAST(ascii(o_orderstatus) AS BIGINT) AS status
                  FROM {orders}) AS o ON l_orderkey = o_orderkey""",
        "medication_order_profile": """
            SELECT DISTINCT CAST(ascii(o_orderstatus) AS BIGINT) AS medication_order_profile_key,
                   CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Sent'
                        ELSE 'Cancelled' END AS order_status
            FROM {orders}""",
    }


def clinical_ctes() -> str:
    """The views as a WITH list for DuckDB, under their view names."""
    tables = {t: t for t in BASE_TABLES}
    return ",\n".join(f"{n} AS ({sql.format(**tables)})" for n, sql in clinical_sql().items())


def clinical_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The views as Spark plans."""
    texts = clinical_sql()

    def read(view: str) -> DataFrame:
        used = [t for t in BASE_TABLES if "{" + t + "}" in texts[view]]
        return spark.sql(texts[view], **{t: base_table(spark, folder, t) for t in used})

    return Warehouse(read)
