"""The flat sales table and the indicators computed on it and on the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camadas.functions.keys import spread_nulls
from camadas.operators.dedup import first_per_key
from camadas.plans.star import DISCOUNT, GROSS, ON_TIME

Tables = Mapping[str, DataFrame]

FLAT_SOURCES = (
    "pedidos", "clientes", "cupons", "pagamentos", "entregas", "itens_pedido", "produtos", "categorias",
)
# Output column names of the flat sales table.
FLAT_SALES = {
    "id_item": "id_item",
    "id_pedido": "id_pedido",
    "data_pedido": "data_pedido",
    "ano": "year(data_pedido)",
    "ano_mes": "date_format(data_pedido, 'yyyy-MM')",
    "status_pedido": "status",
    "cliente": "cliente",
    "cidade": "cidade",
    "estado": "estado",
    "produto": "produto",
    "categoria": "categoria",
    "marca": "marca",
    "cupom": "cupom",
    "quantidade": "quantidade",
    "valor_unitario": "valor_unitario",
    "valor_bruto": GROSS,
    "valor_desconto": DISCOUNT,
    "receita_liquida": "subtotal",
    "forma_pagamento": "forma_pagamento",
    "status_pagamento": "status_pagamento",
    "status_entrega": "status_entrega",
    "entrega_no_prazo": ON_TIME,
}


def first_per_order(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """The row with the lowest id of each order, so that joining it cannot multiply items."""
    rows = df.select("id_pedido", key, *columns)
    return first_per_key(rows, ["id_pedido"], [key]).drop(key)


def flat_sales(t: Tables, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per order item with everything a dashboard shows, or only the named columns.

    Everything that belongs to the order (customer, coupon, first payment, first delivery) is joined
    while the data has order grain, and payments, deliveries and items all meet it on the order id,
    so they share one partitioning. Item rows move for the product as well. For the whole table they
    meet the product first: its three texts go through the second shuffle, not the order's eleven
    columns. Named columns mostly come with a filter on orders, so there the order comes first. The
    looked-up sides hold one row per key, so a side none of whose columns is asked for is not joined.
    """
    whole, columns = not columns, list(columns or FLAT_SALES)

    def wants(*names: str) -> bool:
        return any(n in columns for n in names)

    orders = t["pedidos"].select("id_pedido", "id_cliente", "id_cupom", "data_pedido", "status")
    if wants("cliente", "cidade", "estado"):
        customer = t["clientes"].selectExpr("id_cliente", "nome as cliente", "cidade", "estado")
        orders = orders.join(customer, "id_cliente", "left")
    if wants("cupom"):
        coupon = t["cupons"].selectExpr("id_cupom as _coupon", "codigo as cupom")
        same = spread_nulls(F.col("id_cupom"), F.col("id_pedido")) == F.col("_coupon")
        orders = orders.join(coupon, same & F.col("id_cupom").isNotNull(), "left")
    if wants("forma_pagamento", "status_pagamento"):
        payment = first_per_order(
            t["pagamentos"], "id_pagamento", "forma_pagamento", "status_pagamento"
        )
        orders = orders.join(payment, "id_pedido", "left")
    if wants("status_entrega", "entrega_no_prazo"):
        delivery = first_per_order(
            t["entregas"], "id_entrega", "status_entrega", "data_entrega_prevista",
            "data_entrega_real",
        )
        orders = orders.join(delivery, "id_pedido", "left")
    items = t["itens_pedido"]
    if not wants("produto", "marca", "categoria"):
        flat = items.join(orders, "id_pedido")
    else:
        product = t["produtos"].selectExpr("id_produto", "nome_produto as produto", "marca", "id_categoria")
        if wants("categoria"):
            category = t["categorias"].selectExpr("id_categoria", "nome_categoria as categoria")
            product = product.join(category, "id_categoria", "left")
        if whole:
            flat = items.join(product, "id_produto", "left").join(orders, "id_pedido")
        else:
            flat = items.join(orders, "id_pedido").join(product, "id_produto", "left")
    return flat.selectExpr(*(f"{FLAT_SALES[c]} as {c}" for c in columns))


def _ratio(over: Column, under: Column, digits: int = 4) -> Column:
    """Null when there is nothing to divide by."""
    return F.round(over.cast("double") / F.nullif(under, F.lit(0)), digits)


def dashboard_filter(
    flat: DataFrame, months=None, categories=None, states=None, methods=None
) -> DataFrame:
    """The dashboard's drop-down filters; an empty choice keeps everything."""
    choices = {
        "ano_mes": months, "categoria": categories, "estado": states, "forma_pagamento": methods,
    }
    for column, wanted in choices.items():
        if wanted:
            flat = flat.filter(F.col(column).isin(*wanted))
    return flat


def in_months(column: str, months: Sequence[str]) -> Column:
    """Whether a date lies in one of the months (yyyy-MM), as date ranges that scans can prune by."""
    numbers = sorted({int(m[:4]) * 12 + int(m[5:7]) - 1 for m in months})
    starts = [n for n in numbers if n - 1 not in numbers]
    ends = [n + 1 for n in numbers if n + 1 not in numbers]

    def first_day(n: int) -> Column:
        return F.lit(f"{n // 12:04d}-{n % 12 + 1:02d}-01").cast("date")

    ranges = [(F.col(column) >= first_day(a)) & (F.col(column) < first_day(b)) for a, b in zip(starts, ends)]
    return reduce(Column.__or__, ranges)


def dashboard_sales(
    t: Tables, columns: Sequence[str], months=None, categories=None, states=None, methods=None
) -> DataFrame:
    """The flat table under the dashboard's filters, months applied to the orders before any join.

    The other filters compare looked-up columns; Spark moves them to the looked-up side by itself.
    """
    if months:
        t = {**{n: t[n] for n in FLAT_SOURCES}, "pedidos": t["pedidos"].filter(in_months("data_pedido", months))}
    return dashboard_filter(flat_sales(t, columns), None, categories, states, methods)


def headline(flat: DataFrame) -> DataFrame:
    """Revenue, orders, average ticket and share of delivered orders.

    Items are folded to one row per order first; all distinct counts then are plain counts.
    """
    status = F.col("status_entrega")
    orders = flat.groupBy("id_pedido").agg(
        F.sum("receita_liquida").alias("net"),
        F.max(F.coalesce(status == "entregue", F.lit(False))).alias("delivered"),
        F.max(F.coalesce(status != "", F.lit(False))).alias("shipped"),
    )
    return orders.agg(
        F.sum("net").alias("faturamento_total"),
        F.count(F.lit(1)).alias("qtd_pedidos"),
        _ratio(F.sum("net"), F.count(F.lit(1))).alias("ticket_medio"),
        _ratio(F.count_if("delivered"), F.count_if("shipped")).alias("pct_entregues"),
    )


def revenue_by_month(flat: DataFrame) -> DataFrame:
    return flat.groupBy("ano_mes").agg(F.sum("receita_liquida").alias("faturamento"))


def top_products(flat: DataFrame, n: int = 10) -> DataFrame:
    """Best sellers by quantity; the name decides between equals."""
    sold = flat.groupBy("produto").agg(F.sum("quantidade").alias("quantidade"))
    return sold.orderBy(F.col("quantidade").desc(), "produto").limit(n)


def best_sellers(t: Tables, n: int = 10) -> DataFrame:
    """``top_products`` of the flat table, with items summed per product id before names are joined."""
    items = t["itens_pedido"].join(t["pedidos"].select("id_pedido"), "id_pedido", "left_semi")
    sold = items.groupBy("id_produto").agg(F.sum("quantidade").alias("quantidade"))
    names = t["produtos"].select("id_produto", F.col("nome_produto").alias("produto"))
    return top_products(sold.join(names, "id_produto", "left"), n)


def rows_per_year(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ano").agg(F.count(F.lit(1)).alias("linhas")).orderBy("ano")


def revenue_indicators(sales: DataFrame) -> DataFrame:
    gross, cut = F.sum("valor_bruto"), F.sum("valor_desconto")
    return sales.agg(
        gross.alias("receita_bruta"),
        F.sum("receita_liquida").alias("receita_liquida"),
        cut.alias("valor_desconto"),
        _ratio(cut * 100, gross).alias("pct_desconto"),
    )


def order_indicators(sales: DataFrame) -> DataFrame:
    orders = sales.groupBy("id_pedido").agg(
        F.sum("quantidade").alias("items"), F.sum("receita_liquida").alias("net")
    )
    return orders.agg(
        F.sum("items").alias("itens_vendidos"),
        F.count(F.lit(1)).alias("pedidos_distintos"),
        _ratio(F.sum("net"), F.count(F.lit(1))).alias("ticket_medio"),
    )


def revenue_by_axis(sales: DataFrame, customer: DataFrame, product: DataFrame) -> DataFrame:
    """Net revenue by month, customer, product, brand, category and supplier in one pass.

    The fact is summed by month, by customer key and by product key, combined in every map task, so what
    is shuffled are keys. Names meet these sums, not the fact: one join on (kind, key), in which no key
    is hot, and the axes of a product are taken from its one sum.
    """
    month, who, what = 0, 1, 2
    axes = {who: ("cliente",), what: ("produto", "marca", "categoria", "fornecedor")}
    keys = sales.select(
        F.date_format("data_pedido", "yyyy-MM").alias("_mes"), "cliente_key", "produto_key", "receita_liquida"
    )
    sets = [[F.col(c)] for c in ("_mes", "cliente_key", "produto_key")]
    sums = keys.groupingSets(sets, "_mes", "cliente_key", "produto_key").agg(
        F.sum("receita_liquida").alias("_net"), F.grouping_id().alias("_set")
    )
    kind = F.when(F.col("_set") == 0b011, month).when(F.col("_set") == 0b101, who).otherwise(what)
    sums = sums.select(kind.alias("_kind"), F.coalesce("cliente_key", "produto_key").alias("_key"), "_mes", "_net")

    def pairs(kind: int, values: Sequence[Column]) -> Column:
        return F.array(*(F.struct(F.lit(a).alias("eixo"), v.cast("string").alias("valor")) for a, v in zip(axes[kind], values)))

    nothing = [F.lit(None)] * 4
    names = customer.select(
        F.lit(who).alias("_kind"), F.col("cliente_key").alias("_key"), pairs(who, [F.col("nome")]).alias("_pairs")
    ).unionByName(product.select(
        F.lit(what).alias("_kind"), F.col("produto_key").alias("_key"),
        pairs(what, [F.col(c) for c in ("nome_produto", "marca", "nome_categoria", "nome_fornecedor")]).alias("_pairs"),
    ))
    months = F.array(F.struct(F.lit("mes").alias("eixo"), F.col("_mes").alias("valor")))
    unnamed = F.when(F.col("_kind") == month, months).when(F.col("_kind") == who, pairs(who, nothing)).otherwise(
        pairs(what, nothing))
    named = sums.join(names, ["_kind", "_key"], "left").select(
        F.inline(F.coalesce("_pairs", unnamed)), "_net")
    return named.groupBy("eixo", "valor").agg(F.sum("_net").alias("receita_liquida"))


def payment_indicators(payments: DataFrame) -> DataFrame:
    return payments.groupBy("forma_pagamento", "status_pagamento").agg(
        F.sum("valor_aprovado").alias("valor_aprovado"),
        F.sum("quantidade_pagamentos").alias("pagamentos"),
    )


def delivery_indicators(deliveries: DataFrame) -> DataFrame:
    """Open deliveries have no lead time, delay or punctuality and count in none of them."""
    return deliveries.agg(
        _ratio(F.sum("prazo_real_dias"), F.count("prazo_real_dias")).alias("prazo_medio_dias"),
        F.sum("atraso_dias").alias("dias_de_atraso"),
        _ratio(F.count_if("entrega_no_prazo") * 100, F.count("entrega_no_prazo")).alias(
            "pct_no_prazo"
        ),
    )


def review_indicators(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        _ratio(F.sum("nota"), F.count("nota")).alias("nota_media"),
        _ratio(F.count_if("avaliacao_positiva") * 100, F.count("avaliacao_positiva")).alias(
            "pct_positivas"
        ),
    )
