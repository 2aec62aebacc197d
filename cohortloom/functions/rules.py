"""Declarative value-set rules and drug classes, compiled to Column expressions."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions.expressions import all_of, any_of, like_any


@dataclass(frozen=True)
class Branch:
    """One way a terminology row can qualify; every criterion given must hold.

    ``guarded`` says whether events that qualify through this branch must also
    lie strictly before the index date.
    """

    code_sets: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    bases: tuple[str, ...] = ()
    base_between: tuple[str, str] | None = None
    code_prefix: str | None = None
    name_like: tuple[str, ...] = ()
    guarded: bool = True

    def condition(self, case_sensitive: bool = False) -> Column:
        tests = []
        if self.code_sets:
            tests.append(F.col("diagnosis_code_set").isin(*self.code_sets))
        if self.codes:
            tests.append(F.col("diagnosis_code").isin(*self.codes))
        if self.bases:
            tests.append(F.col("diagnosis_code_base").isin(*self.bases))
        if self.base_between:
            tests.append(F.col("diagnosis_code_base").between(*self.base_between))
        if self.code_prefix:
            tests.append(F.col("diagnosis_code").startswith(self.code_prefix))
        if self.name_like:
            tests.append(like_any(F.col("diagnosis_name"), self.name_like, case_sensitive))
        if not tests:
            raise ValueError("a branch needs at least one criterion")
        return all_of(tests)


@dataclass(frozen=True)
class Rule:
    """A named value set: the OR of its branches.

    ``guard_scope`` is ``"all"`` when the before-index guard covers every
    branch, or ``"last_branch"`` when it covers only the last one, as in SQL
    that writes ``a OR b AND guard`` without parentheses. ``name`` is the matrix
    column; ``label`` is what rows of the condition say, by default the name.
    """

    name: str
    branches: tuple[Branch, ...]
    guard_scope: str = "all"
    label: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "label", self.label or self.name)
        if self.guard_scope not in ("all", "last_branch"):
            raise ValueError(f"unknown guard_scope: {self.guard_scope}")
        if not self.branches:
            raise ValueError("a rule needs at least one branch")

    def scoped_branches(self) -> tuple[Branch, ...]:
        if self.guard_scope == "all":
            return self.branches
        unguarded = tuple(replace(b, guarded=False) for b in self.branches[:-1])
        return unguarded + self.branches[-1:]

    def condition(self, guarded: bool | None = None, case_sensitive: bool = False) -> Column:
        """TRUE or FALSE, never NULL; ``guarded`` picks one kind of branch."""
        picked = [
            b.condition(case_sensitive)
            for b in self.scoped_branches()
            if guarded is None or b.guarded == guarded
        ]
        return F.coalesce(any_of(picked), F.lit(False))

    @property
    def has_guarded(self) -> bool:
        return any(b.guarded for b in self.scoped_branches())

    @property
    def has_unguarded(self) -> bool:
        return not all(b.guarded for b in self.scoped_branches())


@dataclass(frozen=True)
class DrugClass:
    """LIKE patterns of a drug class, by the name column they apply to."""

    label: str
    either: tuple[str, ...] = ()
    brand: tuple[str, ...] = ()
    generic: tuple[str, ...] = ()

    def patterns(self) -> list[tuple[str, str]]:
        """(column, pattern) pairs."""
        brand = [("medication_name", p) for p in self.either + self.brand]
        generic = [("generic_name", p) for p in self.either + self.generic]
        return brand + generic

    def condition(self, brand: Column, generic: Column, case_sensitive: bool = False) -> Column:
        """TRUE or FALSE, never NULL: a NULL name leaves the other name to decide."""
        matched = like_any(brand, self.either + self.brand, case_sensitive) | like_any(
            generic, self.either + self.generic, case_sensitive
        )
        return F.coalesce(matched, F.lit(False))
