"""Code lists and rules as data: tables joined to the dimensions that carry the codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.rules import Branch, Rule
from cohortloom.operators.sizing import broadcast_small

# One criterion a row, under a code set or, where that is NULL, under any. ``field`` says what
# is compared (code, base or name) with a code, a text range, a prefix or a LIKE pattern.
RULE_TABLE = (
    "value_set string, guarded boolean, field string, code_set string, "
    "code string, low string, high string, prefix string, pattern string"
)
GRAM = 3  # characters of a pattern that are looked up in names


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as rows of :data:`RULE_TABLE`."""
    rows = [
        (rule.name, branch.guarded, field, code_set, *criterion)
        for rule in rules
        for branch in rule.scoped_branches()
        for field, criterion in _criteria(branch)
        for code_set in branch.code_sets or (None,)
    ]
    return spark.createDataFrame(rows, RULE_TABLE)


def _criteria(branch: Branch) -> list[tuple[str, tuple]]:
    given = [bool(x) for x in (branch.codes, branch.bases, branch.base_between, branch.code_prefix, branch.name_like)]
    if sum(given) != 1:
        raise ValueError("a row of a rule table holds one criterion; this branch has another number")
    rows = [("code", (code, None, None, None, None)) for code in branch.codes]
    rows += [("base", (base, None, None, None, None)) for base in branch.bases]
    if branch.base_between:
        rows.append(("base", (None, *branch.base_between, None, None)))
    if branch.code_prefix:
        rows.append(("code", (None, None, None, branch.code_prefix, None)))
    return rows + [("name", (None, None, None, None, pattern)) for pattern in branch.name_like]


def value_set_from_table(
    terminology: DataFrame, table: DataFrame, case_sensitive: bool = False
) -> DataFrame:
    """Distinct (value_set, diagnosis_key, guarded) of all value sets in a rule table.

    Every criterion is found by an equal key, so no rule is held against every term:

    * a code by itself, a prefix by itself,
    * a text range by what its ends have in common, since every text between two others starts
      with that,
    * a pattern by the first characters of its longest literal run.

    Terms are looked up by all their prefixes, and names by all runs of up to three characters;
    what the keys bring together is then tested exactly. A rule table that fits is broadcast, so
    that the terms are not shuffled.
    """
    fold = (lambda c: c) if case_sensitive else F.lower
    pattern = fold(F.col("pattern"))
    key = (
        F.when(F.col("code").isNotNull(), F.col("code"))
        .when(F.col("prefix").isNotNull(), F.col("prefix"))
        .when(F.col("pattern").isNotNull(), F.substring(_longest_run(pattern), 1, GRAM))
        .otherwise(_common_prefix(F.col("low"), F.col("high")))
    )
    # In a pattern from a table a backslash is a character like any other too.
    escaped = F.replace(pattern, F.lit("\\"), F.lit("\\\\"))
    (rules,) = broadcast_small(table.withColumns({"key": key, "pattern": escaped}))

    def terms(field: str, value: Column, keys: Column) -> DataFrame:
        listed = terminology.select("diagnosis_key", "diagnosis_code_set", value.alias("value"))
        return listed.where("value IS NOT NULL").select(
            F.lit(field).alias("term_field"), "diagnosis_key", "diagnosis_code_set", "value", F.explode(keys).alias("term_key")
        )

    value = F.col("value")
    prefixes = F.transform(F.sequence(F.lit(0), F.length(value)), lambda n: value.substr(F.lit(1), n))
    looked_up = (
        terms("code", F.col("diagnosis_code"), prefixes)
        .unionAll(terms("base", F.col("diagnosis_code_base"), prefixes))
        .unionAll(terms("name", fold(F.col("diagnosis_name")), _grams(value)))
    )
    matches = (
        F.when(F.col("code").isNotNull(), value == F.col("code"))
        .when(F.col("prefix").isNotNull(), F.startswith(value, F.col("prefix")))
        .when(F.col("pattern").isNotNull(), F.like(value, F.col("pattern")))
        .otherwise(value.between(F.col("low"), F.col("high")))
    )
    system = F.col("code_set").isNull() | (F.col("code_set") == F.col("diagnosis_code_set"))
    met = (F.col("term_key") == F.col("key")) & (F.col("term_field") == F.col("field"))
    found = looked_up.join(rules, met & system & matches)
    return found.select("value_set", "diagnosis_key", "guarded").distinct()


def _common_prefix(low: Column, high: Column) -> Column:
    lengths = F.sequence(F.lit(0), F.least(F.length(low), F.length(high)))
    start = lambda text, n: text.substr(F.lit(1), n)
    shared = F.filter(lengths, lambda n: start(low, n) == start(high, n))
    return start(low, F.size(shared) - 1)


def _longest_run(pattern: Column) -> Column:
    """The longest run of a LIKE pattern without wildcards; of equal ones the greatest."""
    runs = F.transform(F.split(pattern, "[%_]"), lambda run: F.struct(F.length(run).alias("n"), run.alias("run")))
    return F.array_max(runs)["run"]


def _grams(text: Column) -> Column:
    """Every run of up to GRAM characters, the empty one included."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))

    def of_length(n: int) -> Column:
        return F.transform(places, lambda i: text.substr(i, F.lit(n)))

    runs = [of_length(n) for n in range(1, GRAM + 1)]
    return F.array_distinct(F.concat(F.array(F.lit("")), *runs))


def of_code_table(dimension: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows of a dimension whose code columns are a row of ``codes``.

    With a code system among the columns of ``codes``, system and code go together.
    """
    (listed,) = broadcast_small(codes)
    return dimension.join(listed, codes.columns, "left_semi")
