"""Columns that give the driver's tables the roles of a materials catalogue: formulas, units and texts made from keys, with the same in SQL.

The tables hold no formula. A formula is made of a cation, a metal and an anion with their counts, all picked
by a key, so that there are as many rows as the table has and the values repeat as catalogues' do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

CATIONS = ("Li", "Na", "K", "Mg")
METALS = ("La", "Zr", "P", "Al", "Ge", "Ti", "B")
ANIONS = ("O", "S", "Cl", "F", "H", "Br")


def pick(values: tuple[str, ...], key: Column) -> Column:
    """A value by key modulo the number of values."""
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def sql_pick(values: tuple[str, ...], key: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[({key}) % {len(values)} + 1]"


def _count(key: Column, most: int) -> Column:
    return F.when(key % most == 0, "").otherwise((key % most + 1).cast("string"))


def formula_of(key: Column) -> Column:
    part = lambda n: F.floor(key / n)
    return F.concat(pick(CATIONS, key), _count(part(2), 7), pick(METALS, part(4)), _count(part(3), 3), pick(ANIONS, part(28)), _count(part(5), 12))


def sql_formula(key: str) -> str:
    count = lambda k, most: f"case when ({k}) % {most} = 0 then '' else (({k}) % {most} + 1)::varchar end"
    return " || ".join([sql_pick(CATIONS, key), count(f"{key} // 2", 7), sql_pick(METALS, f"{key} // 4"), count(f"{key} // 3", 3), sql_pick(ANIONS, f"{key} // 28"), count(f"{key} // 5", 12)])


def formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """formula: the distinct formulas of the parts."""
    return table(spark, sf_dir, "part").select(formula_of(F.col("p_partkey")).alias("formula")).distinct()


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts with their formula."""
    return table(spark, sf_dir, "part").withColumn("formula", formula_of(F.col("p_partkey")))


SQL_FORMULAS = f"(select distinct {sql_formula('p_partkey')} as formula from part)"
SQL_PARTS = f"(select *, {sql_formula('p_partkey')} as formula from part)"
#: Element and count of every part of a formula, in order of appearance: a row each.
SQL_ELEMENTS = "select formula, p[1] as element, coalesce(try_cast(nullif(p[2], '') as double), 1.0) as n from (select formula, unnest(list_zip(regexp_extract_all(formula, '([A-Z][a-z]?)([0-9.]*)', 1), regexp_extract_all(formula, '([A-Z][a-z]?)([0-9.]*)', 2))) as p from {source})"
#: Reduced formulas of generated ones: three different elements with whole counts.
SQL_REDUCED = """select formula, string_agg(element || case when n // d = 1 then '' else (n // d)::varchar end, '' order by element) as reduced from (
  select *, gcd(gcd(first_value(n) over w, nth_value(n, 2) over w), nth_value(n, 3) over w) as d from (
    select formula, element, coalesce(nullif(c, '')::bigint, 1) as n, k from (
      select formula, unnest(regexp_extract_all(formula, '([A-Z][a-z]?)([0-9]*)', 1)) as element, unnest(regexp_extract_all(formula, '([A-Z][a-z]?)([0-9]*)', 2)) as c, unnest([1, 2, 3]) as k from {source}))
  window w as (partition by formula order by k rows between unbounded preceding and unbounded following)) group by 1"""
