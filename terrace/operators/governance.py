"""Row filters, column masks and tag-driven policies, applied when a table is read.

A row is seen only where the predicate is TRUE. Nothing is bypassed: administrators are a group in the predicates.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ADMINS, APPROVERS, RETENTION, PRICING = "security-admins", "sales-approvers", "customer-retention-team", "pricing-team"


@dataclass(frozen=True)
class Principal:
    user: str
    groups: frozenset[str] = frozenset()

    def member(self, group: Column | str) -> Column:
        """Is the principal in this group? Unknown groups and null are no."""
        group = F.lit(group) if isinstance(group, str) else group
        return F.coalesce(group.isin(*sorted(self.groups)), F.lit(False)) if self.groups else F.lit(False)


def regional_and_status(p: Principal, region: Column, status: Column) -> Column:
    admin = p.member(ADMINS)
    return (admin | p.member(F.concat(F.lit("region-"), region))) & ((status != "DRAFT") | admin | p.member(APPROVERS))


def customer_status(p: Principal, status: Column) -> Column:
    return (status != "CHURNED") | p.member(ADMINS) | p.member(RETENTION)


def classification_department(p: Principal, classification: Column, department: Column) -> Column:
    admin = p.member(ADMINS)
    return ((classification != "restricted") | admin) & ((department == "general") | admin | p.member(F.concat(F.lit("dept-"), department)))


def discount_rate(p: Principal, value: Column) -> Column:
    return F.when(p.member(ADMINS) | p.member(PRICING), value)


@dataclass
class Governance:
    """Tags, owners, filters, masks and policies of tables; what a read by a principal shows."""

    allowed: dict[str, set[str] | None] = field(default_factory=dict)
    table_tags: dict[str, dict[str, str]] = field(default_factory=dict)
    column_tags: dict[tuple[str, str], dict[str, str]] = field(default_factory=dict)
    owners: dict[str, str] = field(default_factory=dict)
    principals: set[str] = field(default_factory=set)
    filters: dict[str, tuple[Callable, tuple[str, ...]]] = field(default_factory=dict)
    masks: dict[tuple[str, str], Callable] = field(default_factory=dict)
    policies: list[tuple[str, Callable, tuple[tuple[str, str | None], ...]]] = field(default_factory=list)
    tables: dict[str, Callable[[SparkSession], DataFrame]] = field(default_factory=dict)
    sessions: list[tuple[SparkSession, Principal]] = field(default_factory=list)

    def register(self, table: str, load: Callable[[SparkSession], DataFrame]) -> None:
        """A table that SQL may read; `load` makes it in a given session."""
        self.tables[table] = load
        self._refresh(table)

    def session(self, spark: SparkSession, principal: Principal) -> SparkSession:
        """A session in which each registered table's name is a view of what the principal may see. Views follow filters,
        masks, tags and policies that are set later. Tables aren't named otherwise there; registering one under a name of the
        catalogue hides that, so base tables should be paths, or views of another session."""
        own = spark.newSession()
        self.sessions.append((own, principal))
        for table in self.tables:
            self._refresh(table, own, principal)
        return own

    def _refresh(self, table: str, *one) -> None:
        """Make the views of a table anew. Where its rules contradict each other there is none, so nothing is read unfiltered."""
        asked = ([one] if one else self.sessions) if table in self.tables else []
        for session, _ in asked:
            session.catalog.dropTempView(table)
        for session, principal in asked:
            self.secure_read(self.tables[table](session), table, principal).createOrReplaceTempView(table)

    def define_tag(self, key: str, values: set[str] | None = None) -> None:
        """A governed tag; with `values`, only those may be set."""
        self.allowed[key] = values

    def _checked(self, tags: dict[str, str]) -> dict[str, str]:
        for k, v in tags.items():
            if k not in self.allowed:
                raise ValueError(f"tag {k} isn't defined")
            if self.allowed[k] is not None and v not in self.allowed[k]:
                raise ValueError(f"{v} isn't allowed for tag {k}")
        return tags

    def tag_table(self, table: str, **tags: str) -> None:
        self.table_tags.setdefault(table, {}).update(self._checked(tags))
        self._refresh(table)

    def tag_column(self, table: str, column: str, **tags: str) -> None:
        self.column_tags.setdefault((table, column), {}).update(self._checked(tags))
        self._refresh(table)

    def set_owner(self, name: str, owner: str) -> None:
        if owner not in self.principals:
            raise ValueError(f"no principal {owner}")
        self.owners[name] = owner

    def set_row_filter(self, table: str, predicate: Callable, *columns: str) -> None:
        if table in self.filters:
            raise ValueError(f"{table} has a row filter")
        self.filters[table] = (predicate, columns)
        self._refresh(table)

    def set_mask(self, table: str, column: str, mask: Callable) -> None:
        self.masks[table, column] = mask
        self._refresh(table)

    def create_policy(self, name: str, predicate: Callable, *tags: tuple[str, str | None]) -> None:
        """A filter for all tables, present and future, that have a column for each (tag, value); no value: any."""
        self.policies.append((name, predicate, tags))
        for table in self.tables:
            self._refresh(table)

    def _bound(self, table: str, tags: tuple) -> list[str] | None:
        out = []
        for key, value in tags:
            hit = [c for (t, c), has in self.column_tags.items() if t == table and key in has and (value is None or has[key] == value)]
            if not hit:
                return None
            out.append(hit[0])
        return out

    def secure_read(self, df: DataFrame, table: str, principal: Principal) -> DataFrame:
        rules = [self.filters[table]] if table in self.filters else []
        rules += [(f, tuple(cols)) for _, f, tags in self.policies if (cols := self._bound(table, tags)) is not None]
        if len(rules) > 1:
            raise ValueError(f"more than one row filter applies to {table}")
        for predicate, columns in rules:
            df = df.filter(predicate(principal, *map(F.col, columns)))
        for (t, column), mask in self.masks.items():
            if t == table:
                df = df.withColumn(column, mask(principal, F.col(column)))
        return df

    def tags(self, spark: SparkSession) -> DataFrame:
        """All tags as rows: table_name, column_name (null for a table's), tag, value."""
        rows = [(t, None, k, v) for t, x in self.table_tags.items() for k, v in x.items()] + [(t, col, k, v) for (t, col), x in self.column_tags.items() for k, v in x.items()]
        return spark.createDataFrame(rows, "table_name string, column_name string, tag string, value string")


def search_as(gov: Governance, table: str, chunks: DataFrame, vectors: DataFrame, query: DataFrame, principal: Principal, k: int = 5) -> DataFrame:
    """Similarity search over the chunks that the principal may see."""
    from terrace.operators import vector

    seen = gov.secure_read(chunks, table, principal)
    return vector.top_k(vectors.join(seen.select("chunk_id"), "chunk_id", "left_semi"), query, k, key="chunk_id")
