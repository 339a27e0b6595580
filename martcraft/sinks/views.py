"""Views (P2, SNK12): SQL text over a session variable for the business date.

The text of a view is resolved each time the view is read, so a view made today shows tomorrow's
closed days tomorrow: only the variable is set again.  Within one read the variable is a constant,
and each half of a current view prunes to its own partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from martcraft.operators.union import common_schema, current_view
from martcraft.plans.registry import Job, order_jobs

BUSINESS_DATE = "business_date"
# The tables with an intraday twin.
CURRENT_TABLES = ["sales_daily", "product_sales", "traffic", "traffic_keyword", "members", "orders", "order_items",
                  "order_attribution", "ad_sales", "adkeyword_sales", "keyword_sales", "domain_sales", "ad_effect",
                  "sales_pervisitor"]


def set_business_date(spark: SparkSession, day: dt.date | None = None) -> None:
    """The date that current views treat as today; None: the session's current date, asked at each read."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {BUSINESS_DATE} DATE")
    if day is not None:
        spark.sql(f"SET VARIABLE {BUSINESS_DATE} = DATE '{day.isoformat()}'")


def _name(n: str) -> str:
    return "`" + n.replace("`", "``") + "`"


def current_view_sql(spark: SparkSession, view: str, final: str, intraday: str, date_col: str = "report_date") -> str:
    """CREATE VIEW text: closed days of ``final`` and the business date of ``intraday``, columns by name (SO2, SO3)."""
    a, b = spark.table(final), spark.table(intraday)
    types = common_schema(a, b)
    today = f"coalesce(session.{BUSINESS_DATE}, current_date())"

    def half(df: DataFrame, table: str, op: str) -> str:
        cols = ", ".join(f"CAST({_name(c) if c in df.columns else 'NULL'} AS {t.simpleString()}) AS {_name(c)}"
                         for c, t in types.items())
        return f"SELECT {cols} FROM {_name(table)} WHERE {_name(date_col)} {op} {today}"

    return (f"CREATE OR REPLACE TEMPORARY VIEW {_name(view)} AS "
            f"{half(a, final, '<')} UNION ALL {half(b, intraday, '=')}")


class ViewRegistry:
    """SNK12: named derived views, re-created in dependency order.

    A builder is a function of the session giving a frame, or SQL text (a SELECT, or a function of the session
    giving CREATE VIEW text)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.builders: dict = {}
        self.deps: dict[str, tuple[str, ...]] = {}

    def register(self, name: str, builder: str | Callable[[SparkSession], DataFrame | str],
                 deps: Iterable[str] = ()) -> None:
        self.builders[name] = builder
        self.deps[name] = tuple(deps)

    def refresh(self, *names: str) -> list[str]:
        """Re-create the named views (default: all) and the views they rest on, those first."""
        jobs = [Job(n, lambda _: None, tuple(d for d in self.deps[n] if d in self.builders)) for n in self.builders]
        wanted, todo = set(), list(names or self.builders)
        while todo:
            n = todo.pop()
            if n not in wanted:
                wanted.add(n)
                todo += [d for d in self.deps[n] if d in self.builders]
        done = [j.name for j in order_jobs(jobs) if j.name in wanted]
        for n in done:
            made = self.builders[n]
            made = made if isinstance(made, str) else made(self.spark)
            if isinstance(made, DataFrame):
                made.createOrReplaceTempView(n)
            else:
                self.spark.sql(made if made.lstrip().upper().startswith("CREATE") else
                               f"CREATE OR REPLACE TEMPORARY VIEW {_name(n)} AS {made}")
        return done


def register_live_views(spark: SparkSession, pairs: dict[str, tuple[str, str]], day: dt.date | None = None,
                        date_col: str = "report_date") -> ViewRegistry:
    """``<name>_current`` for every (final table, intraday table) pair, following the business date."""
    set_business_date(spark, day)
    registry = ViewRegistry(spark)
    for name, (final, intraday) in pairs.items():
        registry.register(f"{name}_current", lambda s, v=f"{name}_current", a=final, b=intraday:
                          current_view_sql(s, v, a, b, date_col), (final, intraday))
    registry.refresh()
    return registry


def register_current_views(spark: SparkSession, pairs: dict, as_of: dt.date, date_col: str = "report_date") -> list[str]:
    """``<name>_current`` of (final, intraday) frames for one fixed day."""
    done = []
    for name, (final, intraday) in pairs.items():
        current_view(final, intraday, as_of, date_col).createOrReplaceTempView(f"{name}_current")
        done.append(f"{name}_current")
    return done
