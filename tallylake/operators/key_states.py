"""All rules of the source system from one mergeable state.

Every row of a table says which keys it holds, which keys it refers to and which column rules it breaks.
Said of the same key space, holders and references meet in one grouping, so a table is read once
for all of its rules, and uniqueness and references need no join. The counts of a key add up:
states of different loads merge by adding them, and the verdicts of the sum are those of all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.schema import ACCOUNT, CARD, FOREIGN_KEYS, SPECS, ForeignKey, TableSpec, Tables
from tallylake.sources import storage

# Key spaces, by number: primary keys, unique columns, and (account, member) pairs, which cards and
# accounts of the same member share; then one entry per column rule, whose key is empty.
_KEYS = [(spec.name, spec.primary_key) for spec in SPECS.values() if spec.primary_key]
_UNIQUE = [(spec.name, column) for spec in SPECS.values() for column in spec.unique]
_RULES = [("not_null", spec.name, c) for spec in SPECS.values() for c in spec.required]
_RULES += [("length", spec.name, c.name) for spec in SPECS.values() for c in spec.bounded]
SPACES = [("key", *k) for k in _KEYS] + [("unique", *u) for u in _UNIQUE]
SPACES += [("owner", CARD, "id_associado")] + _RULES
_NUMBER = {space: number for number, space in enumerate(SPACES)}
_OWNER = _NUMBER["owner", CARD, "id_associado"]

# The references to a parent are counted apart, in one column each.
_ROLE = {
    fk: 1 + sum(other.parent == fk.parent for other in FOREIGN_KEYS[:at])
    for at, fk in enumerate(FOREIGN_KEYS)
}
REFERENCES = [f"refs_{role}" for role in range(1, 1 + max(_ROLE.values()))]
COUNTS = ["held", *REFERENCES]
SCHEMA = "space int, number bigint, text string, " + ", ".join(f"{c} bigint" for c in COUNTS)


def _parent_space(table: str) -> int:
    return _NUMBER["key", table, SPECS[table].primary_key]


def _integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _numeric_spaces(frames: Mapping[str, DataFrame]) -> set[int]:
    """Spaces whose keys are whole numbers wherever they are held or referred to."""
    numeric = {_NUMBER["key", t, c] for t, c in _KEYS if _integral(frames[t], c)}
    numeric |= {_NUMBER["unique", t, c] for t, c in _UNIQUE if _integral(frames[t], c)}
    for fk in FOREIGN_KEYS:
        if not _integral(frames[fk.child], fk.column):
            numeric.discard(_parent_space(fk.parent))
    return numeric


# Expressions are put together as SQL text: a call to the session for each of their hundreds of
# nodes would take longer than the job on a small table.


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _entry(space: int, number: str, text: str, role: int) -> str:
    return (
        f"named_struct('space', {space}, 'number', CAST({number} AS BIGINT), "
        f"'text', CAST({text} AS STRING), 'role', {role})"
    )


def _key_entry(space: int, column: str, role: int, numeric: set[int]) -> str:
    if space in numeric:
        return _entry(space, _name(column), "NULL", role)
    return _entry(space, "NULL", _name(column), role)


def _owner_entry(account: str, member: str, role: int, numeric: set[int]) -> str:
    """The pair of an account and a member; a missing member equals a missing member."""
    account, member = _name(account), _name(member)
    of_member = f"coalesce('=' || CAST({member} AS STRING), '-')"
    if _parent_space(ACCOUNT) in numeric:
        return _entry(_OWNER, account, f"IF({account} IS NULL, NULL, {of_member})", role)
    name = f"CAST({account} AS STRING)"
    return _entry(_OWNER, "NULL", f"length({name}) || ':' || {name} || {of_member}", role)


def _entries(df: DataFrame, spec: TableSpec, numeric: set[int]) -> DataFrame:
    """(space, number, text, role): what each row of a table says."""
    said = []
    if spec.primary_key:
        said.append(_key_entry(_parent_space(spec.name), spec.primary_key, 0, numeric))
    said += [_key_entry(_NUMBER["unique", spec.name, c], c, 0, numeric) for c in spec.unique]
    said += [
        _key_entry(_parent_space(fk.parent), fk.column, _ROLE[fk], numeric)
        for fk in FOREIGN_KEYS
        if fk.child == spec.name
    ]
    if spec.name == ACCOUNT:
        said.append(_owner_entry(spec.primary_key, "id_associado", 0, numeric))
    if spec.name == CARD:
        said.append(_owner_entry("id_conta", "id_associado", 1, numeric))

    tests = {("not_null", spec.name, c): f"{_name(c)} IS NULL" for c in spec.required}
    tests |= {
        ("length", spec.name, c.name): f"coalesce(length({_name(c.name)}) > {c.max_length}, false)"
        for c in spec.bounded
    }
    every = f"array({', '.join(said)})"
    if tests:
        # most rows break nothing, so the list of breaches is built for the others alone
        broken = [f"IF({test}, {_entry(_NUMBER[rule], 'NULL', repr(''), 0)}, NULL)" for rule, test in tests.items()]
        listed = f"concat({every}, array_compact(array({', '.join(broken)})))"
        every = f"IF({' OR '.join(tests.values())}, {listed}, {every})"
    return df.selectExpr(f"inline({every})").where("number IS NOT NULL OR text IS NOT NULL")


def _added(rows: DataFrame, counts: Iterable[Column]) -> DataFrame:
    return rows.groupBy("space", "number", "text").agg(*counts)


def state(tables: Tables) -> DataFrame:
    """One row per key that is held or referred to and per broken column rule; each table is read once."""
    frames = tables.by_name()
    numeric = _numeric_spaces(frames)
    rows = reduce(
        DataFrame.unionByName,
        [_entries(frames[spec.name], spec, numeric) for spec in SPECS.values()],
    )
    return _added(rows, [F.expr(f"count_if(role = {k}) AS {c}") for k, c in enumerate(COUNTS)])


def merged(*states: DataFrame) -> DataFrame:
    """The state of all rows from the states of parts that share no row."""
    rows = reduce(DataFrame.unionByName, states)
    return _added(rows, [F.sum(c).alias(c) for c in COUNTS])


def _per_space(states: DataFrame) -> DataFrame:
    figures = [
        "sum(held) AS total",
        "count_if(held > 1) AS repeated",
        "sum(greatest(held - 1, 0)) AS excess",
    ]
    for role, refs in enumerate(REFERENCES, 1):
        figures += [f"sum(IF(held = 0, {refs}, 0)) AS lost_{role}", f"sum(held * {refs}) AS matched_{role}"]
    return states.groupBy("space").agg(*map(F.expr, figures))


def verdicts(states: DataFrame) -> DataFrame:
    """(regra, tabela, coluna, violacoes) for every rule of every table, zero included.

    ``states`` has one row per key, as :func:`state` and :func:`merged` give it.
    """

    def figure(space: int, name: str) -> str:
        return f"coalesce(max({name}) FILTER (WHERE space = {space}), 0)"

    wanted = [(("primary_key", *k), figure(_NUMBER["key", *k], "excess")) for k in _KEYS]
    wanted += [(("unique", *u), figure(_NUMBER["unique", *u], "excess")) for u in _UNIQUE]
    wanted += [(rule, figure(_NUMBER[rule], "total")) for rule in _RULES]
    wanted += [
        (("foreign_key", fk.child, fk.column), figure(_parent_space(fk.parent), f"lost_{_ROLE[fk]}"))
        for fk in FOREIGN_KEYS
    ]
    # cards that meet their account, without those that meet it with the same member
    to_account = _ROLE[ForeignKey(CARD, "id_conta", ACCOUNT)]
    met = figure(_parent_space(ACCOUNT), f"matched_{to_account}")
    wanted.append((("same_member", CARD, "id_associado"), f"{met} - {figure(_OWNER, 'matched_1')}"))

    one = _per_space(states).agg(*[F.expr(f"{count} AS v{k}") for k, (_, count) in enumerate(wanted)])
    lines = [
        f"named_struct('regra', '{rule}', 'tabela', '{table}', 'coluna', '{column}', 'violacoes', v{k})"
        for k, ((rule, table, column), _) in enumerate(wanted)
    ]
    return one.selectExpr(f"inline(array({', '.join(lines)}))")


def record(states: DataFrame, load_id: str, path: str) -> None:
    """Keep the state of one load; a repeated load replaces its own state only."""
    storage.replace_partitions(states.withColumn("carga", F.lit(load_id)), path, ["carga"])


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """The state of all loads kept at ``path``: the sources are not read."""
    return merged(spark.read.schema(f"{SCHEMA}, carga string").parquet(path).drop("carga"))
