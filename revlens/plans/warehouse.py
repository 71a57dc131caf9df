"""The layered model wired in dependency order.

    users ---------> stg_users ---------> stg_user_id_mapping
    orders --------> stg_orders
    order_items  \\
    products ----> stg_order_items -> customer_status -> dim_customers_gold
    stg_order_items -> order_lines (items folded per order, day, status)
    order_lines + stg_orders + dim -------------------> fact_sales_performance
    stg_order_items --------------------------------> fact_order_items
    stg_orders + stg_order_items + users + mapping + dim -> vw_sales_analysis

Each layer is built on first use. Without ``target`` the layers stay lazy
and Catalyst plans each report from the raw scans (identical sub-plans in
one query share their shuffles). With ``target`` every table is written
there and read back -- the CREATE OR REPLACE TABLE barrier of the
warehouse -- so later layers and reports start from stored tables, not
from lineage, and an executor loss costs at most the layer being written.

The warehouse keeps the order view as a view (re-evaluated by every
report). ``materialize_view=True`` stores it like a table instead: the same
rows, computed once for all the reports that read it.

``fact_order_items`` is a projection of ``stg_order_items``; the warehouse
publishes it as a table, so it is written like the others. A session that
wants to spare the second copy of the item data passes
``store_item_fact=False`` and reads it as a view over the stored items.

Silver orders and items, order lines and order metrics are written in files dealt
by order, if the source makes them by order, and the customer layers in files dealt
by customer. What joins or folds them by that key reads them without a shuffle. Files
of a gated, guarded or partitioned warehouse aren't dealt.

A written layer is a new version in a folder of its own, named in the
target's manifest together with what it was built from (reference date,
rules, lead-time mode, raw files, this library's code) and a hash of its
content. ``reuse_stored=True`` reads a stored layer only if it was built from
the same things; otherwise it is built anew. ``vacuum`` deletes old versions.

``quality_gate=True`` checks the rules of :data:`GATES` in the job that writes
a layer: violating rows are kept aside with their reasons, and a version that
breaks a ``refuse`` rule is not committed. ``partition_by=MONTHLY`` lays the
facts out by month, so that reports over some months read those folders only.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import re
import threading
import uuid
from functools import cached_property, lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from revlens.config import DEFAULT_RULES, Rules
from revlens.operators import gold, leakage, silver, view
from revlens.operators.joins import JoinGuard
from revlens.plans.sqlview import view_sql
from revlens.sources.raw import RawTables
from revlens.sources.sinks import ASIDE, Gate, Manifest, QualityError, bucketed, drop_folder, file_identity, is_bucketed, materialize, quarantined, read_table

# Partition columns per written table: the facts by month. Not the default, because
# none of the published reports filters on time.
MONTHLY: dict[str, tuple[str, ...]] = {"fact_order_items": ("ano_mes",), "fact_sales_performance": ("ano_mes",)}

# Row rules of the written layers, as SQL conditions of a violation.
GATES: dict[str, Gate] = {
    "stg_users": Gate({"id_nulo": "customer_id IS NULL"}, {}, {"sem_email": "email IS NULL"}),
    "stg_orders": Gate(
        {"id_nulo": "order_id IS NULL"}, {}, {"envio_antes_do_pedido": "shipped_at < created_at", "sem_usuario": "user_id IS NULL"}
    ),
    "stg_order_items": Gate(
        {"id_nulo": "order_item_id IS NULL", "sem_pedido": "order_id IS NULL", "preco_negativo": "sale_price < 0"},
        {},
        {"produto_desconhecido": "cost IS NULL", "preco_zero": "sale_price = 0"},
    ),
    "dim_customers_gold": Gate(
        {}, {"id_nulo": "customer_id IS NULL", "escore_invalido": "NOT rfm_score RLIKE '^[0-3]{3}$'", "ltv_negativo": "ltv < 0"}, {}
    ),
    "fact_order_items": Gate({}, {"id_nulo": "order_item_id IS NULL"}, {"sem_data": "data_pedido IS NULL"}),
}

# Columns each written file is sorted by. The reports over the stored view
# filter on the order status (and the trends on the day), so sorted files
# let Parquet row-group statistics skip the other statuses.
SORT_WITHIN: dict[str, tuple[str, ...]] = {
    "vw_sales_analysis": ("status_pedido", "data_pedido"),
}

# Layers that depend on the raw tables alone, not on the reference date or the rules.
SILVER = frozenset({"src_users", "stg_users", "stg_orders", "stg_order_items", "stg_user_id_mapping", "order_lines", "order_metrics"})

OWNER = "revlens.target"  # property of a catalog view: the warehouse it was registered from

# The published tables, in dependency order.
TABLES = (
    "stg_users",
    "stg_orders",
    "stg_order_items",
    "stg_user_id_mapping",
    "dim_customers_gold",
    "fact_sales_performance",
    "fact_order_items",
)


@lru_cache(maxsize=1)
def code_digest() -> str:
    """A digest of the modules that decide what the layers hold."""
    home = Path(__file__).resolve().parent.parent
    files = sorted(f for part in ("operators", "functions", "sources", "plans") for f in (home / part).glob("*.py"))
    return hashlib.sha256(b"".join(f.read_bytes() for f in [home / "config.py", *files])).hexdigest()


def raw_identity(spark: SparkSession, folders: tuple[str, ...]) -> str:
    """A digest of the paths, lengths and modification times of the files in ``folders``."""
    return hashlib.sha256(repr(file_identity(spark, list(folders))).encode()).hexdigest()


class Warehouse:
    """Lazily built layers over one set of raw tables.

    raw                 the four raw tables (``users``, ``orders``, ``order_items``, ``products``)
    as_of               reference date for every recency rule (None: today)
    rules               business constants (see :class:`revlens.config.Rules`)
    target              folder to write layers to; None keeps every layer lazy
    calendar_lead_time  count shipping lead time in calendar days instead of elapsed days
    materialize_view    store the order view like a table (same rows, computed once)
    reuse_stored        read a layer already complete under ``target`` instead of rewriting it
    store_item_fact     write ``fact_order_items`` (False: a view over the stored items)
    keep_null_email     keep every registration without an e-mail, not one of them
    fold_orphans        count purchases of removed ids for the customer that survived
    partition_by        partition columns of written tables, e.g. ``MONTHLY``
    quality_gate        check ``GATES`` while writing; ``gate_report`` has what each layer's job found
    join_guard          watch the N:1 joins of written layers: ``"report"`` (see ``joins``), or ``"refuse"`` to commit
                        a version when a key repeats on the unique side of one

    Each layer is a ``cached_property``: built (and written) on first access,
    then shared by everything that reads it.
    """

    def __init__(
        self,
        raw: RawTables,  # or any object with the same four attributes
        as_of: _dt.date | str | None = None,
        rules: Rules = DEFAULT_RULES,
        target: str | None = None,
        calendar_lead_time: bool = False,
        materialize_view: bool = False,
        reuse_stored: bool = False,
        store_item_fact: bool = True,
        keep_null_email: bool = False,
        fold_orphans: bool = False,
        partition_by: dict[str, tuple[str, ...]] | None = None,
        quality_gate: bool = False,
        join_guard: str | None = None,
    ) -> None:
        if join_guard not in (None, "report", "refuse"):
            raise ValueError(f"join_guard: report, refuse or None, not {join_guard}")
        self.raw = raw
        self.as_of = as_of
        self.rules = rules
        self.target = target.rstrip("/") if target else None
        self.calendar_lead_time = calendar_lead_time
        self.materialize_view = materialize_view
        self.reuse_stored = reuse_stored
        self.store_item_fact = store_item_fact
        self.keep_null_email = keep_null_email
        self.fold_orphans = fold_orphans
        self.partition_by = partition_by or {}
        self.quality_gate = quality_gate
        self.join_guard = join_guard
        self.gate_report: dict[str, dict] = {}
        self._written: dict[str, str] = {}
        self._dealt: set[str] = set()  # written layers whose files are dealt by a key
        self._lock = threading.RLock()

    def path(self, name: str) -> str | None:
        """Where a layer that this warehouse has written or reused lives (None: lazy)."""
        return self._written.get(name)

    def built_from(self, name: str) -> str | None:
        """What a layer depends on, as a string to compare; None when the raw files are not known."""
        if self._raw_identity is None:
            return None
        known = {
            "raw": self._raw_identity,
            "code": code_digest(),
            "calendar_lead_time": self.calendar_lead_time,
            "keep_null_email": self.keep_null_email,
            "partition_by": self.partition_by.get(name, ()),
            "quality_gate": self.quality_gate,
            "join_guard": self.join_guard is not None,
        }
        if name not in SILVER:
            as_of = self.as_of if self.as_of is not None else _dt.date.today()
            known |= {"as_of": str(as_of), "rules": repr(self.rules), "fold_orphans": self.fold_orphans}
        return json.dumps(known, sort_keys=True)

    @cached_property
    def raw_folders(self) -> tuple[str, ...]:
        """The folders that hold the raw files."""
        tables = [getattr(self.raw, t) for t in ("users", "orders", "order_items", "products")]
        return tuple(sorted({f.rpartition("/")[0] for t in tables for f in t.inputFiles()}))

    @cached_property
    def _raw_identity(self) -> str | None:
        return raw_identity(self.raw.users.sparkSession, self.raw_folders) if self.raw_folders else None

    def is_current(self) -> bool:
        """Whether the raw files are still those this warehouse was built from."""
        return self._raw_identity == (raw_identity(self.raw.users.sparkSession, self.raw_folders) if self.raw_folders else None)

    def _guard(self) -> JoinGuard | None:
        """A guard for the joins of a layer that is going to be written."""
        return JoinGuard() if self.join_guard and self.target is not None else None

    @cached_property
    def _by_order(self) -> str | None:
        """The key that order layers are dealt by when they are written; only if the source makes them by order."""
        return "order_id" if hasattr(self.raw, "with_headers") else None

    def _undealt(self, name: str) -> DataFrame:
        """A layer read as plain files, for a join with a side that may have hot keys: AQE splits those only between two exchanges."""
        df = getattr(self, name)
        return df.sparkSession.read.schema(df.schema).parquet(self._written[name]) if name in self._dealt else df

    def _keep(self, name: str, df: DataFrame, guard: JoinGuard | None = None, by: str | None = None) -> DataFrame:
        """``df``, written if there is a target. ``by``: the key by which its rows come, and its files are dealt."""
        if self.target is None:
            return df
        with self._lock:  # one writer per layer even if reports run in threads
            spark, basis = df.sparkSession, self.built_from(name)
            manifest = Manifest(spark, self.target)
            gate = GATES.get(name) if self.quality_gate else None
            if gate is not None or self.join_guard or name in self.partition_by:
                by = None
            if self.reuse_stored and basis is not None:
                record = manifest.served(name, basis)
                if record is not None:
                    self._written[name] = record["path"]
                    if by is not None and "buckets" in record["observed"] and is_bucketed(spark, record["path"]):
                        self._dealt.add(name)
                        return bucketed(spark, df.schema, record["path"], by, record["observed"]["buckets"])
                    return read_table(spark, record["path"] if gate is None else f"{record['path']}/{ASIDE}=false").select(*df.columns)
            version = f"{self.target}/{name}/v-{uuid.uuid4().hex}"
            buckets = None if by is None else (by, int(spark.conf.get("spark.sql.shuffle.partitions")))
            out, observed = materialize(df, version, self.partition_by.get(name, ()), SORT_WITHIN.get(name, ()), gate, buckets)
            if guard is not None:
                observed["joins"] = guard.counts()
                broken = {join: n["repeated"] for join, n in observed["joins"].items() if n["repeated"]}
                if broken and self.join_guard == "refuse":
                    drop_folder(spark, version)
                    raise QualityError(f"{name}: not committed, keys that should be unique repeat in the joins {broken}")
            manifest.add(name, version, basis, observed)
            self._written[name] = version
            if buckets is not None:
                self._dealt.add(name)
            if gate is not None:
                self.gate_report[name] = observed
            return out

    def quarantined(self, name: str) -> DataFrame | None:
        """Rows of a written layer that its gate kept aside, with the rules they broke."""
        return quarantined(self.raw.users.sparkSession, self._written[name])

    def observed(self, name: str) -> dict:
        """What the job that wrote the served version of a layer saw: ``linhas``, ``conteudo`` and its gate's counts."""
        record = Manifest(self.raw.users.sparkSession, self.target).served(name)
        return record["observed"] if record else {}

    def joins(self) -> dict[str, dict[str, dict[str, int]]]:
        """layer -> join -> rows_in, rows_out, unique_side, repeated, of the layers written or reused under ``join_guard``."""
        seen = {name: self.observed(name).get("joins", {}) for name in self._written}
        return {name: found for name, found in seen.items() if found}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions of each layer."""
        return Manifest(self.raw.users.sparkSession, self.target).vacuum(keep)

    def drop(self) -> None:
        """Delete every version of every layer under ``target``; nothing else is touched."""
        spark = self.raw.users.sparkSession
        manifest = Manifest(spark, self.target)
        for records in manifest.records().values():
            for record in records:
                drop_folder(spark, record["path"])
        drop_folder(spark, manifest.path)
        self._written.clear()
        self._dealt.clear()

    def __getattribute__(self, name: str):
        # cached_property is not thread-safe; serialise first builds of a layer
        if name in _LAYERS:
            with object.__getattribute__(self, "_lock"):
                return object.__getattribute__(self, name)
        return object.__getattribute__(self, name)

    # -- silver ------------------------------------------------------------
    @cached_property
    def stg_users(self) -> DataFrame:
        return self._keep("stg_users", silver.stg_users(self.raw.users, self.keep_null_email))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._keep(
            "stg_orders", silver.stg_orders(self.raw.orders, self.calendar_lead_time), by=self._by_order
        )

    @cached_property
    def stg_order_items(self) -> DataFrame:
        guard = self._guard()
        # a source with headers of its own joins them last; a guarded join counts the items as they are published
        late = getattr(self.raw, "with_headers", None) if guard is None else None
        items = self.raw.order_items if late is None else self.raw.item_rows
        return self._keep("stg_order_items", silver.stg_order_items(items, self.raw.products, guard, late), guard, self._by_order)

    @cached_property
    def stg_user_id_mapping(self) -> DataFrame:
        guard = self._guard()
        return self._keep(
            "stg_user_id_mapping", silver.stg_user_id_mapping(self.raw.users, self.stg_users, guard), guard
        )

    # -- gold --------------------------------------------------------------
    @cached_property
    def order_lines(self) -> DataFrame:
        """Items folded per (order, user, day, status): the input of every item aggregate."""
        return self._keep("order_lines", gold.order_lines(self.stg_order_items), by=self._by_order)

    @cached_property
    def customer_metrics(self) -> DataFrame:
        """Read by the dimension and the view, so stored like a layer."""
        return self._keep("customer_metrics", gold.customer_metrics(None, self.rules, lines=self.order_lines), by="user_id")

    def _metrics_of_customers(self) -> DataFrame:
        """What the labels are made from: a removed id's purchases are its own, or with ``fold_orphans`` the survivor's."""
        if not self.fold_orphans:
            return self.customer_metrics
        lines = gold.resolve_users(self.order_lines, self.stg_user_id_mapping)
        return gold.customer_metrics(None, self.rules, lines=lines)

    @cached_property
    def customer_status(self) -> DataFrame:
        return gold.customer_segments(gold.rfm_scores(self._metrics_of_customers(), self.as_of, self.rules), self.rules)

    @cached_property
    def dim_customers_gold(self) -> DataFrame:
        guard = self._guard()
        return self._keep(
            "dim_customers_gold",
            gold.dim_customers_gold(
                self.stg_users,
                self.stg_order_items,
                self.as_of,
                self.rules,
                guard=guard,
                metrics=self._metrics_of_customers(),
            ),
            guard,
            "customer_id",
        )

    @cached_property
    def order_metrics(self) -> DataFrame:
        """Read by the month series and the order fact, so stored like a layer."""
        guard = self._guard()
        return self._keep("order_metrics", gold.order_metrics(None, self.stg_orders, self.order_lines, guard), guard, self._by_order)

    @cached_property
    def monthly_series(self) -> DataFrame:
        return gold.monthly_series(self.order_metrics, self.rules)

    @cached_property
    def fact_sales_performance(self) -> DataFrame:
        guard = self._guard()
        return self._keep(
            "fact_sales_performance",
            gold.fact_sales_performance(
                None, self.stg_orders, self._undealt("dim_customers_gold"), self.rules, metrics=self.order_metrics, guard=guard
            ),
            guard,
        )

    @cached_property
    def fact_order_items(self) -> DataFrame:
        df = gold.fact_order_items(self.stg_order_items)
        return self._keep("fact_order_items", df) if self.store_item_fact else df

    # -- serving view ------------------------------------------------------
    @cached_property
    def vw_sales_analysis(self) -> DataFrame:
        guard = self._guard() if self.materialize_view else None
        df = view.vw_sales_analysis(
            self.stg_orders,
            self.stg_order_items,
            self.raw.users,
            self.stg_user_id_mapping,
            self.dim_customers_gold,
            self.as_of,
            self.rules,
            metrics=self.customer_metrics,
            lines=self.order_lines,
            guard=guard,
        )
        return self._keep("vw_sales_analysis", df, guard) if self.materialize_view else df

    @cached_property
    def leakage_rollup(self) -> DataFrame:
        """Read by all leakage reports, so stored like a layer."""
        return self._keep("leakage_rollup", leakage.leakage_rollup(self.vw_sales_analysis))

    @cached_property
    def src_users(self) -> DataFrame:
        """Raw registrations as a stored table, for the catalog view: it shows attributes of removed ones, too."""
        return self._keep("src_users", self.raw.users.select("id", "country", "city", "age", "gender", "traffic_source", "created_at"))

    def register(
        self, staging_db: str = "crm_staging", analytics_db: str = "crm_analytics", live_view: bool = False
    ) -> dict[str, str]:
        """Expose the layers under the warehouse's table names for SQL users.

        Silver tables go to ``staging_db``, gold tables and the order view to
        ``analytics_db``, as external catalog tables over the served versions
        (the databases are created inside ``target``, never in the working
        directory). A table of that name is replaced only if its files lie
        under ``target``; any other one is left alone and raises. A layer
        that isn't stored is registered as a temporary view under its own
        name. Returns name -> qualified name. Requires ``target``.

        ``live_view`` registers the order view as a catalog view over the
        silver tables and the dimension instead of its stored rows: each query
        evaluates it, so rows added to the tables show without a rebuild, and
        without ``as_of`` recency counts to the day of the query.
        """
        if self.target is None:
            raise ValueError("register() needs stored layers: build the warehouse with a target")
        spark = self.raw.users.sparkSession
        names: dict[str, str] = {}
        for db in (staging_db, analytics_db):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{self.target}/{db}.db'")
        tables = (*TABLES, "src_users") if live_view else (*TABLES, "vw_sales_analysis")
        for name in tables:
            df = getattr(self, name)  # written on first access
            if self.path(name) is None:
                df.createOrReplaceTempView(name)
                names[name] = name
                continue
            qualified = f"{staging_db if name in SILVER else analytics_db}.{name}"
            self._make_room(qualified)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            parts = self.partition_by.get(name, ())
            by = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
            folder = self.path(name) + (f"/{ASIDE}=false" if self.quality_gate and name in GATES else "")
            spark.sql(f"CREATE TABLE {qualified} ({columns}) USING parquet{by} LOCATION '{folder}'")
            if parts:
                spark.sql(f"MSCK REPAIR TABLE {qualified}")
            names[name] = qualified
        if live_view:
            qualified = f"{analytics_db}.vw_sales_analysis"
            self._make_room(qualified)
            text = view_sql(f"`{staging_db}`", f"`{analytics_db}`", self.as_of, self.rules)
            spark.sql(f"CREATE VIEW {qualified} TBLPROPERTIES ('{OWNER}' = '{self.target}') AS {text}")
            names["vw_sales_analysis"] = qualified
        return names

    def _make_room(self, qualified: str) -> None:
        """Drop a table or view of that name that this warehouse registered; raise if it is another's."""
        spark = self.raw.users.sparkSession
        if not spark.catalog.tableExists(qualified):
            return
        if not self._is_ours(qualified):
            raise ValueError(f"{qualified} exists and its files are not under {self.target}; it was left alone")
        kind = "VIEW" if spark.catalog.getTable(qualified).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {qualified}")  # external: the files stay

    def _is_ours(self, table: str) -> bool:
        """Whether an external table's files lie under the target, or a view was registered from it."""
        about = {r["col_name"]: r["data_type"] for r in self.raw.users.sparkSession.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        if about.get("Type") == "VIEW":
            return f"{OWNER}={self.target}" in about.get("Table Properties", "").strip("[]").replace("'", "").split(", ")
        home = re.sub(r"^file:/+", "/", self.target) + "/"
        return about.get("Type") == "EXTERNAL" and re.sub(r"^file:/+", "/", about.get("Location", "")).startswith(home)

    def stored(self) -> tuple[str, ...]:
        """The published tables this warehouse writes when it has a ``target``."""
        if self.target is None:
            return ()
        return tuple(t for t in TABLES if t != "fact_order_items" or self.store_item_fact)

    def build_all(self) -> dict[str, DataFrame]:
        """Every published table (written when ``target`` is set) plus the view."""
        out = {name: getattr(self, name) for name in TABLES}
        out["vw_sales_analysis"] = self.vw_sales_analysis
        return out


_LAYERS = frozenset(
    {
        *TABLES,
        "src_users",
        "order_lines",
        "customer_metrics",
        "customer_status",
        "order_metrics",
        "monthly_series",
        "vw_sales_analysis",
        "leakage_rollup",
    }
)
