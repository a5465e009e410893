"""U-01 column mask, U-02 row filter, U-03 secured view.

Catalog-level ``SET MASK`` / ``SET ROW FILTER`` and group functions do not exist in open-source
Spark, so the policies are DataFrame functions applied by a secured reader. Group membership
and site grants come in as small parameter tables; the row filter is a semi join with the
principal's grants, so no grant reaches the driver. A surrogate key that is a function of the
identifier is masked along with it: short identifiers could be found again by hashing them all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C

ALL_SITES = "all_sites"
PHI_READERS = "phi_readers"


@dataclass(frozen=True)
class Principal:
    """``groups``: those of the two groups above that the user is in; ``sites``: granted site ids."""

    name: str
    groups: frozenset
    sites: DataFrame

    @property
    def all_sites(self) -> bool:
        return ALL_SITES in self.groups


def resolve(principal: str, memberships: DataFrame, grants: DataFrame) -> Principal:
    """Groups of ``principal`` (memberships: user, group) and sites (grants: user, site_id). Only the
    two groups that the policies ask for are read, so two rows at most reach the driver."""
    own = memberships.filter((F.col("user") == principal) & F.col("group").isin(ALL_SITES, PHI_READERS))
    groups = {r["group"] for r in own.select("group").distinct().collect()}
    return Principal(principal, frozenset(groups), grants.filter(F.col("user") == principal).select("site_id").distinct())


def mask_column(df: DataFrame, col: str, can_see: bool, literal: str = C.REDACTED) -> DataFrame:
    """U-01: raw value for a privileged reader, else the redaction literal."""
    return df.withColumn(col, F.col(col) if can_see else F.lit(literal))


def row_filter(df: DataFrame, p: Principal, site_col: str = "site_id") -> DataFrame:
    """U-02: everything for ``all_sites`` members, else rows of the principal's own sites."""
    if p.all_sites:
        return df
    sites = p.sites.select(F.col("site_id").alias("_granted"))
    return df.join(sites, F.col(site_col) == F.col("_granted"), "left_semi")


def by_site(df: DataFrame, path: str, site_col: str = "site_id") -> DataFrame:
    """The table written with a partition a site, and read back: under ``row_filter`` the granted sites
    prune its partitions at run time (dynamic partition pruning), so a coordinator's read costs what its
    sites hold. A site's rows are dealt to several files by a hash of the row, so a large one isn't one task."""
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c != site_col]), F.lit(8))
    df.repartition(site_col, salt).write.mode("overwrite").partitionBy(site_col).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def secured(df: DataFrame, p: Principal, masked: Sequence[str], site_col: str = "site_id") -> DataFrame:
    """U-03: filter first (it must see raw values), mask last."""
    out = row_filter(df, p, site_col)
    for c in masked:
        out = mask_column(out, c, PHI_READERS in p.groups)
    return out
