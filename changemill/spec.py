"""Change codes and the descriptions of tables and of how changes are applied."""

from __future__ import annotations

from dataclasses import dataclass


class Op:
    """Change codes found in the op column of a change set (fixed values)."""

    DELETE = 0
    INSERT = 1
    UPDATE = 2
    BEFORE = 4
    TRUNCATE = 5
    PARTIAL_DELETE = 8


#: Codes that steer an apply instead of describing a row.
CONTROL_OPS = (Op.TRUNCATE, Op.PARTIAL_DELETE)

OP_COL = "op_type"
FLAG_COL = "is_deleted"

STYLES = ("replicate", "soft_delete", "history")


@dataclass(frozen=True)
class TableSpec:
    """A routed table: its name in the change files, the target's name, columns and keys."""

    name: str
    target: str
    columns: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class ApplySpec:
    """How one change set is applied to one target.

    ``style`` is ``replicate`` (hard delete), ``soft_delete`` (flag column kept in the
    target) or ``history`` (append only). ``unused_keys`` are the key columns that a
    delete with an incomplete key leaves out. ``partition_cols`` join the merge keys; use
    them only if a key never moves to another partition. ``partition_stable`` vouches for that,
    so that only the partitions which occur in the change set need be read. ``new_columns`` says what happens to
    columns of the change set that the target lacks: ``fail``, ``add`` or ``ignore``.
    """

    keys: tuple[str, ...]
    style: str = "replicate"
    order: tuple[str, ...] = ()
    op_col: str = OP_COL
    flag_col: str = FLAG_COL
    null_safe: bool = True
    unique_keys: bool = True
    truncate: bool = False
    unused_keys: tuple[str, ...] = ()
    partition_cols: tuple[str, ...] = ()
    partition_stable: bool = False
    keyless: bool = False
    split_inserts: bool = False
    merge_history: bool = False
    new_columns: str = "fail"

    def __post_init__(self):
        if self.new_columns not in ("fail", "add", "ignore"):
            raise ValueError("new_columns must be 'fail', 'add' or 'ignore'")
        if self.partition_stable and not self.partition_cols:
            raise ValueError("partition_stable needs partition_cols")
        if self.partition_stable and (self.truncate or self.unused_keys):
            raise ValueError("truncate markers and partial deletes reach partitions that the change set doesn't name")
        if self.keyless and self.style != "soft_delete":
            raise ValueError("keyless tables need the soft_delete style")
        if self.style not in STYLES:
            raise ValueError(f"style must be one of {STYLES}, not {self.style!r}")

    @property
    def merge_keys(self) -> list[str]:
        keys = [k for k in self.keys if k not in (self.op_col, self.flag_col)]
        return keys + [c for c in self.partition_cols if c not in keys]
