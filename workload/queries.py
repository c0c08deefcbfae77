"""Registered queries: every operator of the library over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camadas.entities import ENTITIES, MODELS
from camadas.functions.extjson import NUMBER_WRAPPERS, date_value, decode, encode, number_value
from camadas.functions.keys import day_key, digest, surrogate_key
from camadas.functions.text import cell, clean
from camadas.operators import audit, history, quality, upsert
from camadas.plans import bronze as bronze_plan
from camadas.plans import gold, marts, silver, star
from camadas.plans.carry import carry_changes
from camadas.plans.export import FLAT_TABLE, export_star
from camadas.plans.extract import run_extract
from camadas.plans.increments import ParkedReferences, UniqueSilver
from camadas.session import apply_settings, materialize, scratch_dir
from camadas.sources import bronze, csv_files, landing, synthetic
from camadas.sources.tables import append
from camadas.streaming import merge as stream_merges
from camadas.streaming.ingest import ingest_available
from workload.shop import HELD, SHOP, Shop

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHANGE = "2002-01-01 00:00:00"
EVENT_CHANGE = "1998-06-15 00:00:00"
RUN_AT = datetime(2002, 1, 1, 6, tzinfo=timezone.utc)


def query(fn: Callable[[Shop], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Shop(apply_settings(spark), sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# --- star schema and marts ------------------------------------------------------------------


@query
def fact_sales(s):
    return longs(star.sales(s), "data_key", "ano", "quantidade_itens_registro")


@query
def fact_payments(s):
    return longs(star.payments(s), "data_key", "ano", "quantidade_pagamentos")


@query
def fact_deliveries(s):
    return longs(
        star.deliveries(s), "data_envio_key", "data_prevista_key", "data_real_key", "ano",
        "prazo_previsto_dias", "prazo_real_dias", "atraso_dias", "quantidade_entregas",
    )


@query
def fact_reviews(s):
    return longs(star.reviews(s), "data_key", "ano", "quantidade_avaliacoes")


@query
def dim_customer(s):
    return star.customers(s)


@query
def dim_product(s):
    return star.products(s)


@query
def dim_coupon(s):
    return star.coupons(s)


@query
def dim_calendar(s):
    return longs(
        star.calendar(s), "data_key", "ano", "semestre", "trimestre", "mes", "semana_ano",
        "dia_mes", "dia_semana_numero",
    )


@query
def date_bounds(s):
    return star.day_bounds(s)


@query
def date_spine_union(s):
    """All calendar dates of all tables stacked by name, folded to one row per day."""
    frames = [
        s[t].select(F.col(c).alias("data"))
        for t, columns in star.CALENDAR_DAYS.items() for c in columns
    ]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f)
    seen = stacked.filter("data is not null")
    return seen.groupBy("data").agg(F.count(F.lit(1)).alias("ocorrencias"))


@query
def date_key(s):
    key = day_key(F.col("data_pedido")).cast("bigint")
    return s["pedidos"].select("id_pedido", key.alias("data_key"))


@query
def obt_sales(s):
    return longs(marts.flat_sales(s), "ano")


@query
def first_per_order(s):
    keep = ("forma_pagamento", "status_pagamento", "valor")
    return marts.first_per_order(s["pagamentos"], "id_pagamento", *keep)


@query
def kpi_headline(s):
    return marts.headline(marts.flat_sales(s, ["id_pedido", "receita_liquida", "status_entrega"]))


@query
def kpi_filtered(s):
    need = [
        "id_pedido", "receita_liquida", "status_entrega", "ano_mes", "categoria", "estado",
        "forma_pagamento",
    ]
    chosen = marts.dashboard_sales(
        s, need, months=[f"1997-{m:02d}" for m in range(1, 13)],
        categories=["ECONOMY", "STANDARD", "PROMO"], states=["BR", "AR", "CA", "UN", "NA"],
        methods=["pix", "boleto", "cartao_credito"],
    )
    return marts.headline(chosen)


@query
def revenue_by_month(s):
    return marts.revenue_by_month(marts.flat_sales(s, ["ano_mes", "receita_liquida"]))


@query
def top_products(s):
    return marts.best_sellers(s)


@query
def sales_rows_by_year(s):
    return longs(marts.rows_per_year(star.sales(s)), "ano")


@query
def ind_revenue(s):
    return marts.revenue_indicators(star.sales(s))


@query
def ind_orders(s):
    return marts.order_indicators(star.sales(s))


@query
def ind_revenue_by_axis(s):
    return marts.revenue_by_axis(star.sales(s), star.customers(s), star.products(s))


@query
def ind_payments(s):
    return marts.payment_indicators(star.payments(s))


@query
def ind_deliveries(s):
    return marts.delivery_indicators(star.deliveries(s))


@query
def ind_reviews(s):
    return marts.review_indicators(star.reviews(s))


# --- decode, normalise, hash ------------------------------------------------------------------


_RAW: dict[tuple, DataFrame] = {}


def _raw(s: Shop, table: str, source: str) -> DataFrame:
    """A typed frame as a written table of raw documents, the way a curated table's input arrives.

    What is no contract column stays beside the document.
    """
    key = (s.spark.sparkContext.applicationId, s.sf_dir, table, source)
    if key not in _RAW:
        _RAW[key] = materialize(encode(s[source], ENTITIES[table]), f"raw-{source}")
    return _RAW[key]


def _decoded(s: Shop, table: str, source: str) -> DataFrame:
    return decode(_raw(s, table, source), ENTITIES[table])


def _candidates(s: Shop, table: str, source: str) -> DataFrame:
    """The newest version of every key, by the curated layer's own rule; ``origem`` is the file.

    Uniqueness reads its input twice, so candidates of tables with such a rule are written once.
    """
    raw = _raw(s, table, source)
    origin = F.col("origem") if "origem" in raw.columns else F.lit("a")
    lines = raw.select(
        "raw_document", origin.alias(bronze.SOURCE_FILE), F.lit(RUN_AT).alias(bronze.INGESTED_AT)
    )
    found = silver.candidates(lines, ENTITIES[table], "run", RUN_AT)
    return materialize(found, f"newest-{source}") if ENTITIES[table].unique else found


@query
def json_decode(s):
    return _decoded(s, "pedidos", "pedidos_brutos").drop("raw_document")


@query
def ext_json_encode(s):
    return encode(s["pedidos"], ENTITIES["pedidos"])


@query
def ext_json_round_trip(s):
    return _decoded(s, "entregas", "entregas").drop("raw_document")


@query
def ext_number(s):
    """Each of the three number wrappers, whole and fractional texts, and texts that are no number."""
    wire = "v struct<" + ",".join(f"`{w}`:string" for w in NUMBER_WRAPPERS) + ">"
    key = F.col("o_orderkey")
    wrapper = F.when(key % 3 == 0, "$numberInt").when(key % 3 == 1, "$numberLong").otherwise(
        "$numberDouble"
    )
    text = F.when(key % 17 == 0, "n/a").when(
        key % 3 == 2, F.concat(key.cast("string"), F.lit(".70"))
    ).otherwise(key.cast("string"))
    line = F.concat(F.lit('{"v":{"'), wrapper, F.lit('":"'), text, F.lit('"}}'))
    node = F.from_json(line, wire).getField("v")
    return s["orders"].select(
        "o_orderkey", number_value(node, "bigint").alias("inteiro"),
        number_value(node, "decimal(18,2)").alias("decimal"),
    )


@query
def ext_date(s):
    """Epoch milliseconds before and after 1970, with a sub-second part that is dropped."""
    wire = "v struct<`$date`:struct<`$numberLong`:string>>"
    key = F.col("o_orderkey")
    millis = (F.when(key % 2 == 0, -key).otherwise(key) * 86399999).cast("string")
    line = F.concat(F.lit('{"v":{"$date":{"$numberLong":"'), millis, F.lit('"}}}'))
    node = F.from_json(line, wire).getField("v")
    return s["orders"].select(
        "o_orderkey", date_value(node, "timestamp").alias("instante"),
        date_value(node, "date").alias("dia"),
    )


@query
def normalize_strings(s):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    padded = F.concat(F.lit("  "), name, F.lit(" - "), segment, F.lit("\t "))
    return s["customer"].select(
        "c_custkey", clean(padded, "trim").alias("aparado"), clean(padded, "lower").alias("minusculo"),
        clean(padded, "upper").alias("maiusculo"), clean(padded, "digits").alias("digitos"),
    )


@query
def cell_coercion(s):
    key = F.col("o_orderkey")
    whole = F.when(key % 4 == 0, "").when(key % 4 == 1, F.concat(key.cast("string"), F.lit(".0"))).when(
        key % 4 == 2, "abc").otherwise(key.cast("string"))
    flag = F.when(key % 5 == 0, "true").when(key % 5 == 1, "1").when(key % 5 == 2, "Sim").when(
        key % 5 == 3, "").otherwise("no")
    real = F.when(key % 3 == 0, "").otherwise(F.concat(key.cast("string"), F.lit(".25")))
    day = F.when(key % 7 == 0, "").when(key % 7 == 1, "soon").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return s["orders"].select(
        "o_orderkey", cell(whole, "int").alias("inteiro"), cell(flag, "bool").alias("logico"),
        cell(real, "float").alias("numero"), cell(day, "date").alias("data"),
    )


@query
def record_hash(s):
    return s["produtos"].select(
        "id_produto", digest(["id_produto", "nome_produto", "marca", "estoque"]).alias("hash")
    )


@query
def surrogate_keys(s):
    return s["clientes"].select(
        "id_cliente", surrogate_key(F.col("id_cliente"), F.col("updated_at")).alias("cliente_sk")
    )


# --- quality ------------------------------------------------------------------------------------


@query
def dedup_latest(s):
    return _candidates(s, "pedidos", "pedidos_brutos").select(
        *ENTITIES["pedidos"].columns, F.col(silver.SOURCE_FILE).alias("origem")
    )


@query
def quality_filter(s):
    rule = ENTITIES["clientes"]
    valid = _candidates(s, "clientes", "clientes_brutos").filter(quality.is_valid(rule))
    return valid.select(*rule.columns)


@query
def quality_report(s):
    rule = ENTITIES["clientes"]
    decoded = _decoded(s, "clientes", "clientes_brutos")
    return quality.violation_counts(decoded, quality.all_checks(rule)).filter("broken > 0")


@query
def schema_contract_report(s):
    """The source-side contract of all ten collections, six of them with defects.

    A document is read once, so it is checked as soon as it is made and not written in between.
    """
    reports = []
    for name, entity in ENTITIES.items():
        source = f"{name}_brutos" if f"{name}_brutos" in SHOP else name
        report = quality.document_report(encode(s[source], entity), entity)
        reports.append(report.select(F.lit(name).alias("tabela"), "*"))
    return reduce(DataFrame.unionByName, reports)


@query
def key_uniqueness(s):
    return quality.repeated_keys(s["pedidos_brutos"].filter("id_pedido is not null"), ["id_pedido"])


CUSTOMER_REF, COUPON_REF = ENTITIES["pedidos"].references


@query
def fk_required_semi(s):
    return quality.resolved(s["pedidos"], CUSTOMER_REF, s["clientes_parciais"], "id_pedido")


@query
def fk_optional(s):
    return quality.resolved(s["pedidos"], COUPON_REF, s["cupons_parciais"], "id_pedido")


@query
def fk_orphans(s):
    return quality.orphans(s["pedidos"], CUSTOMER_REF, s["clientes_parciais"])


def _customer_losers(s):
    rule = ENTITIES["clientes"]
    valid = _candidates(s, "clientes", "clientes_brutos").filter(quality.is_valid(rule))
    return quality.flag_duplicates(valid, rule.unique[0], rule.key, ["updated_at"])


@query
def unique_rule_kept(s):
    return _customer_losers(s).filter("not _loser").select("id_cliente", "cpf", "updated_at")


@query
def unique_rule_rejected(s):
    """Conditional rule: at most one approved payment per order."""
    rule = ENTITIES["pagamentos"]
    flagged = quality.flag_duplicates(s["pagamentos"], rule.unique[0], rule.key, ["updated_at"])
    return flagged.filter("_loser").select(
        "id_pagamento", "id_pedido", "updated_at", F.lit(rule.unique[0].kind).alias("tipo_rejeicao")
    )


def _assessed_orders(s):
    parents = {"clientes": s["clientes_parciais"], "cupons": s["cupons_parciais"]}
    candidates = _candidates(s, "pedidos", "pedidos_brutos")
    return quality.assess(candidates, ENTITIES["pedidos"], parents, silver.NEWEST)


def _assessed_customers(s):
    candidates = _candidates(s, "clientes", "clientes_brutos")
    return quality.assess(candidates, ENTITIES["clientes"], {}, silver.NEWEST)


@query
def silver_orders(s):
    """Raw documents to curated rows: decode, de-duplicate, validate, check references."""
    return _assessed_orders(s).filter("_status = 'valid'").select(*ENTITIES["pedidos"].columns)


@query
def quality_log(s):
    log = []
    for assessed, name in ((_assessed_orders(s), "pedidos"), (_assessed_customers(s), "clientes")):
        rule = ENTITIES[name]
        classes = ("field", "business", "referential")
        entries = quality.quality_log(
            assessed, rule, "run", F.lit(RUN_AT), silver.RECORD_HASH, classes
        )
        log.append(entries.select("tabela", "chave_primaria", "tipo_rejeicao", "detalhe"))
    return log[0].unionByName(log[1])


def _accounting(s):
    customers = audit.account(s["clientes_brutos"], _assessed_customers(s), "clientes")
    orders = audit.account(s["pedidos_brutos"], _assessed_orders(s), "pedidos")
    return customers.unionByName(orders)


@query
def quality_accounting(s):
    return _accounting(s)


@query
def run_manifest(s):
    accounts = _accounting(s)
    return audit.totals(accounts, [c for c in audit.SILVER_COUNTERS if c in accounts.columns])


# --- merges and history -----------------------------------------------------------------------------


def _orders_with_hash(s, name):
    columns = [c for c in ENTITIES["pedidos"].columns if c != "updated_at"]
    return s[name].withColumn("_hash", digest(columns))


def _merge_inputs(s):
    target, source = _orders_with_hash(s, "pedidos_antes"), _orders_with_hash(s, "pedidos_lote")
    return target, source


@query
def merge_upsert(s):
    target, source = _merge_inputs(s)
    merged = upsert.merge_upsert(target, source, "id_pedido", "updated_at", "_hash")
    return merged.drop("_hash").withColumnRenamed("_action", "acao")


@query
def merge_metrics(s):
    target, source = _merge_inputs(s)
    actions = upsert.merge_actions(target, source, "id_pedido", "updated_at", "_hash")
    return upsert.action_counts(actions, ["inserted", "updated", "unchanged", "kept"])


@query
def change_classify(s):
    target, source = _merge_inputs(s)
    actions = upsert.merge_actions(target, source, "id_pedido", "updated_at", "_hash")
    return actions.withColumnRenamed("_action", "acao")


@query
def full_sync(s):
    target, source = _merge_inputs(s)
    synced = upsert.full_sync(target, source, "id_pedido", "_hash")
    return synced.drop("_hash").withColumnRenamed("_action", "acao")


@query
def full_sync_metrics(s):
    target, source = _merge_inputs(s)
    actions = upsert.sync_actions(target, source, "id_pedido", "_hash")
    return upsert.action_counts(actions, ["inserted", "updated", "unchanged", "deleted"])


@query
def sync_deleted_keys(s):
    return upsert.deleted_keys(s["pedidos_antes"], s["pedidos_lote"], "id_pedido")


def _customer_versions(s, name):
    return history.with_version_hash(star.customers({"clientes": s[name]}), "cliente_key")


def _customer_history(s):
    first = history.first_versions(_customer_versions(s, "clientes"), "cliente_key", "cliente_sk")
    second = _customer_versions(s, "clientes_depois")
    change = F.to_timestamp(F.lit(CHANGE))
    return history.apply_versions(first, second, "cliente_key", "cliente_sk", change)


@query
def scd2_apply(s):
    return _customer_history(s).select(
        "cliente_key", "nome", "cidade", "cliente_sk", "dw_valid_from", "dw_valid_to",
        "dw_is_current", F.col("_scd_action").alias("acao"),
    )


@query
def scd2_second_change(s):
    """The stored dimension after its first load and a change: closed versions are only added."""
    store = gold.Dimension(s.spark, f"{scratch_dir(s.spark, 'dimension')}/dim_cliente", "cliente_key")
    first = history.first_versions(_customer_versions(s, "clientes"), "cliente_key", "cliente_sk")
    change = F.to_timestamp(F.lit(CHANGE))
    store.apply(materialize(first, "dimension-first"), "cliente_sk", change, "r1")
    store.apply(_customer_versions(s, "clientes_depois"), "cliente_sk", change, "r2")
    return store.read().select(
        "cliente_key", "nome", "cidade", "cliente_sk", "dw_valid_from", "dw_valid_to", "dw_is_current")


@query
def scd2_metrics(s):
    first = history.first_versions(_customer_versions(s, "clientes"), "cliente_key", "cliente_sk")
    second = _customer_versions(s, "clientes_depois")
    return history.version_counts(history.version_actions(first, second, "cliente_key"))



def _two_versions(s, model):
    """Every third key of a dimension has a second version since the change instant."""
    rule = MODELS[model]
    base = history.with_version_hash(star.BUILDERS[model](s), rule.natural_key)
    first = history.first_versions(base, rule.natural_key, rule.key)
    changed = base.filter(F.col(rule.natural_key) % 3 == 0).withColumn(
        history.VERSION_HASH, F.reverse(history.VERSION_HASH)
    )
    change = F.to_timestamp(F.lit(EVENT_CHANGE))
    return history.apply_versions(first, changed, rule.natural_key, rule.key, change)


@query
def pit_join(s):
    looked = history.lookup_as_of(
        star.payments(s), _two_versions(s, "dim_cliente"), "cliente_key", "cliente_sk",
        "data_pagamento", "pagamento_key",
    )
    return looked.select("pagamento_key", "cliente_key", "data_pagamento", "cliente_sk")


@query
def pit_join_merge(s):
    """The same lookup by one ordering of events and versions; busy keys are split by time."""
    looked = history.lookup_by_merge(
        star.payments(s), _two_versions(s, "dim_cliente"), "cliente_key", "cliente_sk", "data_pagamento",
        hot_events=8,
    )
    return looked.select("pagamento_key", "cliente_key", "data_pagamento", "cliente_sk")


@query
def scd2_backdated(s):
    """Changes from 1998 that arrive after those of 2002: intervals are split, later versions stay."""
    base = _customer_versions(s, "clientes")
    moved = base.filter("cliente_key % 4 = 0").withColumn("cidade", F.concat("cidade", F.lit(" 0")))
    again = base.filter("cliente_key % 9 = 0")  # says what held already: no change
    same = base.filter("cliente_key % 6 = 0 and cliente_key % 4 <> 0").withColumn("cidade", F.concat("cidade", F.lit(" 3")))
    new = base.filter("cliente_key % 50 = 1").withColumn("cliente_key", F.col("cliente_key") + 2000000000)

    def since(rows, instant):
        hashed = history.with_version_hash(rows.drop(history.VERSION_HASH), "cliente_key")
        return hashed.withColumn("desde", F.to_timestamp(F.lit(instant)))

    changes = [since(moved, EVENT_CHANGE), since(again, "1997-01-01 00:00:00"), since(same, CHANGE), since(new, EVENT_CHANGE)]
    changes = reduce(DataFrame.unionByName, changes)
    state = _customer_history(s).drop("_scd_action")
    return history.apply_backdated(state, changes, "cliente_key", "cliente_sk", "desde").select(
        "cliente_key", "nome", "cidade", "cliente_sk", "dw_valid_from", "dw_valid_to", "dw_is_current",
        F.col("_scd_action").alias("acao"))


@query
def gold_sales(s):
    """The sales fact with the surrogates of three dimensions as of the order date."""
    dims = {m: _two_versions(s, m) for m in ("dim_cliente", "dim_produto", "dim_cupom")}
    linked = star.linked(s, "fato_vendas", dims)
    return linked.select(
        "venda_key", "data_pedido", "cliente_key", "produto_key", "cupom_key", "receita_liquida",
        "cliente_sk", "produto_sk", "cupom_sk",
    )


# --- extraction and raw ingestion ---------------------------------------------------------------------

CHECKPOINT = datetime(2000, 1, 15, 12, tzinfo=timezone.utc)


@query
def incremental_extract(s):
    return landing.changed_since(s["pedidos"], CHECKPOINT)


@query
def checkpoint_advance(s):
    rows = []
    for name in ENTITIES:
        batch = landing.changed_since(s[name], CHECKPOINT)
        rows.append(landing.next_checkpoint(batch, CHECKPOINT).withColumn("collection", F.lit(name)))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _paths(s):
    path = F.concat(
        F.lit("s3a://lake/landing/shop/pedidos/extraction_date="),
        F.date_format("data_pedido", "yyyy-MM-dd"), F.lit("/run_id=r"),
        (F.col("id_pedido") % 7).cast("string"), F.lit("/part-00000.json"),
    )
    return s["pedidos"].select("id_pedido", path.alias(bronze.SOURCE_FILE))


@query
def path_lineage(s):
    return _paths(s).select(
        "id_pedido", *(c.alias(n) for c, n in zip(
            bronze.path_lineage(F.col(bronze.SOURCE_FILE)), ("dia_extracao", "execucao"))),
    )


@query
def ledger_anti_join(s):
    """Lines of files that an earlier run (odd run ids) has not ingested yet."""
    done = _paths(s).filter(F.col("id_pedido") % 7 % 2 == 1).select(bronze.SOURCE_FILE)
    return bronze.not_ingested(_paths(s), done).select(
        "id_pedido", F.col(bronze.SOURCE_FILE).alias("arquivo")
    )


@query
def ingest_counts(s):
    return _paths(s).agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.count_distinct(bronze.SOURCE_FILE).alias("source_files"),
    )


# --- file based sources and sinks: the whole tables are written out and read back -------------------


def _land(s, root, run_id, source, table, where):
    """Write part of a table as one landing batch."""
    folder = landing.batch_folder(root, "shop", table, RUN_AT.date(), run_id)
    landing.write_batch(s[source].filter(where), ENTITIES[table], folder, compression="gzip")


def _decode_bronze(rows, table):
    lineage = [bronze.EXTRACTION_DATE, bronze.LANDING_RUN, bronze.PIPELINE_RUN]
    named = rows.select("raw_document", *lineage).withColumnsRenamed(
        dict(zip(lineage, ("dia_extracao", "execucao", "carga")))
    )
    return decode(named, ENTITIES[table]).drop("raw_document")


@query
def bronze_scan(s):
    """All orders written as JSON lines and scanned back as undecoded lines."""
    root = scratch_dir(s.spark, "scan")
    _land(s, root, "r1", "pedidos", "pedidos", "true")
    return bronze.scan(s.spark, f"{root}/landing/shop/pedidos").select("raw_document")


@query
def bronze_ingest(s):
    """Two batches and three runs: the second run sees one new batch, the third run none."""
    root = scratch_dir(s.spark, "bronze")
    _land(s, root, "r1", "pedidos", "pedidos", "id_pedido % 3 <> 0")
    bronze_plan.ingest(s.spark, root, "shop", "pedidos", "c1", RUN_AT, RUN_AT)
    _land(s, root, "r2", "pedidos", "pedidos", "id_pedido % 3 = 0")
    for run in ("c2", "c3"):
        bronze_plan.ingest(s.spark, root, "shop", "pedidos", run, RUN_AT, RUN_AT)
    return _decode_bronze(s.spark.read.parquet(f"{root}/bronze/shop/pedidos"), "pedidos")


@query
def ledger_incremental(s):
    """Files the ledger lacks, from the listing and the ledger's folders of those days, after a run that died
    between its append and its ledger entry: only the third batch is new."""
    root = scratch_dir(s.spark, "ledger")
    for run, where in (("r1", "id_pedido % 5 = 0"), ("r2", "id_pedido % 5 = 1"), ("r3", "id_pedido % 5 > 1")):
        _land(s, root, run, "pedidos", "pedidos", where)
        ledger = bronze_plan.FileLedger(s.spark, root, "shop", "pedidos")
        lines = bronze_plan.pending_lines(ledger, f"{root}/landing/shop/pedidos") if run != "r1" else None
        if run == "r1":
            bronze_plan.ingest(s.spark, root, "shop", "pedidos", "c1", RUN_AT, RUN_AT)
        elif run == "r2":
            day = RUN_AT.date()
            ledger.open(day, "c2")
            append(bronze.with_lineage(lines, "c2", F.lit(RUN_AT), day), ledger.table, [bronze.PARTITION])
    ledger.recover()
    new = bronze_plan.pending_lines(ledger, f"{root}/landing/shop/pedidos")
    return decode(new.select("raw_document"), ENTITIES["pedidos"]).drop("raw_document")


@query
def stream_ingest(s):
    """The same two batches through the streaming file source, in two runs of one checkpoint."""
    root = scratch_dir(s.spark, "stream")
    table = f"{root}/bronze/shop/pedidos"
    for batch, rest in (("r1", "id_pedido % 3 <> 0"), ("r2", "id_pedido % 3 = 0")):
        _land(s, root, batch, "pedidos", "pedidos", rest)
        ingest_available(
            s.spark, f"{root}/landing/shop/pedidos", table, f"{root}/checkpoint",
            batch.replace("r", "c"), RUN_AT, RUN_AT,
        ).awaitTermination()
    return _decode_bronze(s.spark.read.parquet(table), "pedidos")


def _stream_state(s, root, name):
    rule = ENTITIES["pedidos"]
    return stream_merges.MergeSink(stream_merges.state_of(s.spark, f"{root}/{name}", rule, 16), rule, name)


@query
def stream_merge(s):
    """The merge as a stream in three triggers: the old state, a batch, then late rows and replays."""
    root = scratch_dir(s.spark, "stream-merge")
    sink = _stream_state(s, root, "pedidos")
    landed = (("r1", (("pedidos_antes", "true"),)), ("r2", (("pedidos_lote", "true"),)),
              ("r3", (("pedidos_antes", "id_pedido % 3 = 0"), ("pedidos_lote", "id_pedido % 4 = 1"))))
    for run, batches in landed:
        for source, where in batches:
            _land(s, root, f"{run}-{source}", source, "pedidos", where)
        stream_merges.merge_available(
            s.spark, f"{root}/landing/shop/pedidos", sink, f"{root}/checkpoint").awaitTermination()
    return sink.state.read().drop(stream_merges.HASH)


@query
def stream_dedup(s):
    """Keyed streaming de-duplication over a backlog years behind the first rows, with repeated files."""
    root = scratch_dir(s.spark, "stream-dedup")
    sink = _stream_state(s, root, "pedidos")
    for run, source, where in (("r1", "pedidos", "id_pedido % 2 = 0 and updated_at >= '1999-01-01'"),
                               ("r2", "pedidos", "true"), ("r3", "pedidos", "id_pedido % 3 <> 0")):
        _land(s, root, run, source, "pedidos", where)
        stream_merges.merge_unseen(
            s.spark, f"{root}/landing/shop/pedidos", sink, f"{root}/checkpoint").awaitTermination()
    return sink.state.read().drop(stream_merges.HASH)


def _lines(s, source, where="true"):
    """Raw lines of a customer source, as one file of one ingest brought them."""
    return _raw(s, "clientes", source).filter(where).select(
        "raw_document", F.lit("a").alias(bronze.SOURCE_FILE), F.lit(RUN_AT).alias(bronze.INGESTED_AT))


@query
def silver_incremental(s):
    """Curated customers after three batches, judged one after another: half, the rest, corrections."""
    table = UniqueSilver(s.spark, scratch_dir(s.spark, "silver-incremental"), ENTITIES["clientes"], 16)
    half = "xxhash64(raw_document) % 2 = 0"
    for source, where in (("clientes_brutos", half), ("clientes_brutos", f"not ({half})"), ("clientes_corrigidos", "true")):
        table.add(_lines(s, source, where))
    return table.read()


@query
def fk_late_parents(s):
    """Orders before some of their customers and coupons; late parents release what waits for them."""
    rule = ENTITIES["pedidos"]
    table = ParkedReferences(s.spark, scratch_dir(s.spark, "late-parents"), rule, 16)
    table.add(s["pedidos"], {"clientes": s["clientes_parciais"], "cupons": s["cupons_parciais"]})
    table.new_parents({"clientes": s["clientes"].filter("id_cliente % 20 = 3")})
    table.new_parents({"cupons": s["cupons"].filter("id_cupom % 20 = 13")})
    done = table.curated.read().withColumn("faltam", F.lit(""))
    parked = table.parked.read().withColumn("faltam", F.array_join("_missing", ",")).drop("_missing")
    return done.unionByName(parked)


@query
def csv_typed_scan(s):
    root = scratch_dir(s.spark, "csv")
    csv_files.write(s["pedidos"].select(*ENTITIES["pedidos"].columns), f"{root}/pedidos.csv", compression="gzip")
    return csv_files.read_typed(s.spark, f"{root}/pedidos.csv", ENTITIES["pedidos"])


@query
def synthetic_orders(s):
    """A synthetic order for every order id of the tables."""
    ids = s["orders"].select((F.col("o_orderkey") + 1).alias("id"))
    return synthetic.orders(ids, customers=1000, coupons=50)


@query
def synthetic_payments(s):
    ids = s["orders"].select((F.col("o_orderkey") + 1).alias("id"))
    return synthetic.payments(ids, orders=1000)


@query
def synthetic_items(s):
    ids = s["orders"].select((F.col("o_orderkey") + 1).alias("id"))
    return synthetic.order_items(ids, orders=1000, products=200)


@query
def synthetic_deliveries(s):
    ids = s["orders"].select((F.col("o_orderkey") + 1).alias("id"))
    return synthetic.deliveries(ids, orders=1000)


@query
def synthetic_reviews(s):
    ids = s["orders"].select((F.col("o_orderkey") + 1).alias("id"))
    return synthetic.reviews(ids, orders=1000, customers=1000, products=200)


@query
def append_evolution(s):
    """Orders appended in two runs, the second of which brings a column the first had not."""
    path = f"{scratch_dir(s.spark, 'evolution')}/pedidos"
    orders = s["pedidos"].withColumn("ano", F.year("data_pedido"))
    append(orders.drop("id_cupom").filter("id_pedido % 2 = 0"), path, ["ano"])
    append(orders.filter("id_pedido % 2 = 1"), path, ["ano"])
    return longs(s.spark.read.option("mergeSchema", "true").parquet(path), "ano")


@query
def star_export(s):
    """All collections as CSV, the star schema built from them as CSV, and its flat table read back."""
    root = scratch_dir(s.spark, "export")
    for name, entity in ENTITIES.items():
        csv_files.write(s[name].select(*entity.columns), f"{root}/in/{name}.csv", compression="gzip")
    export_star(s.spark, f"{root}/in", f"{root}/out", compression="gzip")
    cells = s.spark.read.csv(f"{root}/out/{FLAT_TABLE}.csv", header=True)
    return cells.select(
        cell(F.col("id_item"), "int").alias("id_item"), cell(F.col("id_pedido"), "int").alias("id_pedido"),
        cell(F.col("data_pedido"), "date").alias("data_pedido"), "ano_mes", "cliente", "produto", "cupom",
        "forma_pagamento", "status_entrega", cell(F.col("quantidade"), "int").alias("quantidade"),
        cell(F.col("receita_liquida"), "float").alias("receita_liquida"))


@query
def manifest_document(s):
    """The audit documents of an extraction and an ingest of all collections, read back."""
    root, args = scratch_dir(s.spark, "manifest"), ("shop", "r1", RUN_AT)
    run_extract(s.spark, {n: s[n] for n in ENTITIES}, root, *args, compression="gzip")
    bronze_plan.run_bronze(s.spark, root, *args, RUN_AT)
    entry = "struct<table:string, status:string, document_count:bigint, rows_written:bigint>"
    shape = (f"dag_id string, run_id string, logical_date string, layer string, tables array<{entry}>,"
             " totals struct<document_count:bigint, rows_written:bigint>")
    jobs = (("landing", "source_to_landing"), ("bronze", "landing_to_bronze"))
    documents = [s.spark.read.schema(shape).json(f"{root}/{layer}/_control/{job}") for layer, job in jobs]
    named = reduce(DataFrame.unionByName, documents).select("dag_id", "run_id", "logical_date", "layer", "totals", F.posexplode("tables").alias("posicao", "t"))
    return named.select(
        "dag_id", "run_id", "logical_date", "layer", F.col("t.table").alias("tabela"),
        F.coalesce("t.document_count", "t.rows_written").alias("linhas"),
        F.coalesce("totals.document_count", "totals.rows_written").alias("total"))


@query
def layered_payments(s):
    """Sources to landing, raw, curated and modelled tables: the payment fact with its surrogate."""
    root, names = scratch_dir(s.spark, "lake"), ["clientes", "cupons", "pedidos", "pagamentos"]
    run_extract(s.spark, {n: s[n] for n in names}, root, "shop", "r1", RUN_AT, compression="gzip")
    args = (s.spark, root, "shop", "r1", RUN_AT, RUN_AT)
    bronze_plan.run_bronze(*args, names)
    silver.run_silver(*args, names)
    gold.run_gold(*args, ["dim_cliente", "fato_pagamentos"])
    fact = gold.gold_table(s.spark, root, "shop", MODELS["fato_pagamentos"]).read()
    return longs(fact, "data_key", "ano", "quantidade_pagamentos").drop(
        gold.RECORD_HASH, gold.PIPELINE_RUN, gold.PROCESSED_AT
    )


SECOND_AT = datetime(1998, 6, 15, tzinfo=timezone.utc)
# What ``layered_second_run`` shows of each model: its content and, of facts, the surrogates.
_SHOWN = {
    "dim_tempo": ("data_key", ("ano_mes",), ()),
    "dim_cliente": ("cliente_key", ("cidade",), ("cliente_sk",)),
    "dim_produto": ("produto_key", ("preco", "descricao_categoria", "estado_fornecedor"), ("produto_sk",)),
    "dim_cupom": ("cupom_key", ("ativo",), ("cupom_sk",)),
    "fato_vendas": ("venda_key", ("ano", "quantidade", "status_pedido", "data_pedido"), ("cliente_sk", "produto_sk", "cupom_sk")),
    "fato_pagamentos": ("pagamento_key", ("ano", "valor", "status_pagamento"), ("cliente_sk",)),
    "fato_entregas": ("entrega_key", ("ano", "prazo_previsto_dias"), ("cliente_sk",)),
    "fato_avaliacoes": ("avaliacao_key", ("ano", "nota"), ("cliente_sk", "produto_sk")),
}


@query
def layered_second_run(s):
    """All ten collections and eight models twice: the second cycle carries touched keys only."""
    root = scratch_dir(s.spark, "second-run")
    first = {n: s[n].filter(f"not ({HELD})") if "id_pedido" in s[n].columns else s[n] for n in ENTITIES}
    second = {n: s[f"{n}_2"] for n in ENTITIES}
    start = datetime(1998, 1, 1, tzinfo=timezone.utc)
    for run, at, sources in (("r1", start, first), ("r2", SECOND_AT, second)):
        run_extract(s.spark, sources, root, "shop", run, at, compression="gzip")
        args = (s.spark, root, "shop", run, at, at)
        bronze_plan.run_bronze(*args)
        silver.run_silver(*args)
        gold.run_gold(*args) if run == "r1" else carry_changes(*args)
    shown = []
    for model, (key, content, surrogates) in _SHOWN.items():
        table = gold.gold_table(s.spark, root, "shop", MODELS[model]).read()
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in content]
        keys = [F.coalesce(F.col(c), F.lit("-")) for c in surrogates]
        current = F.col(history.IS_CURRENT) if history.IS_CURRENT in table.columns else F.lit(None).cast("boolean")
        shown.append(table.select(
            F.lit(model).alias("modelo"), F.col(key).cast("bigint").alias("chave"), F.concat_ws("|", *parts).alias("conteudo"),
            F.concat_ws("|", *keys).alias("surrogados"), current.alias("atual")))
    return reduce(DataFrame.unionByName, shown)
