"""Builders of the star schema: four dimensions and four facts from curated tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camadas.entities import MODELS
from camadas.functions.calendar import calendar_columns
from camadas.functions.keys import digest
from camadas.operators.history import lookup_as_of

Tables = Mapping[str, DataFrame]

# The days the calendar has to cover. Birth dates are left out on purpose.
CALENDAR_DAYS = {
    "clientes": ("data_cadastro",),
    "cupons": ("data_validade",),
    "pedidos": ("data_pedido",),
    "pagamentos": ("data_pagamento",),
    "entregas": ("data_envio", "data_entrega_prevista", "data_entrega_real"),
    "avaliacoes": ("data_avaliacao",),
}
# Output column names of the models.
CUSTOMER = (
    "id_cliente as cliente_key", "nome", "genero", "data_nascimento", "cidade", "estado",
    "data_cadastro",
)
COUPON = (
    "id_cupom as cupom_key", "codigo", "desconto_percentual", "valor_minimo", "data_validade",
    "ativo",
)
PRODUCT = (
    "id_produto as produto_key", "nome_produto", "descricao as descricao_produto", "marca",
    "preco", "estoque", "peso_kg", "id_categoria as categoria_key", "nome_categoria",
    "descricao_categoria", "id_fornecedor as fornecedor_key", "nome_fornecedor",
    "estado_fornecedor",
)


def day_number(day: str, name: str) -> str:
    """``day_key`` as SQL."""
    return f"cast(year({day}) * 10000 + month({day}) * 100 + day({day}) as int) as {name}"


GROSS = "try_cast(quantidade * valor_unitario as decimal(18,2))"
DISCOUNT = f"try_cast({GROSS} - subtotal as decimal(18,2))"
ON_TIME = "if(data_entrega_real is not null, data_entrega_real <= data_entrega_prevista, null)"
SALES = (
    "id_item as venda_key", "id_item", "id_pedido",
    day_number("data_pedido", "data_key"), "data_pedido",
    "year(data_pedido) as ano", "id_cliente as cliente_key", "id_produto as produto_key",
    "id_cupom as cupom_key", "status as status_pedido", "quantidade", "valor_unitario",
    "desconto_percentual", f"{GROSS} as valor_bruto", f"{DISCOUNT} as valor_desconto",
    "subtotal as receita_liquida", "1 as quantidade_itens_registro",
)
PAYMENTS = (
    "id_pagamento as pagamento_key", "id_pagamento", "id_pedido",
    day_number("data_pagamento", "data_key"), "data_pagamento",
    "year(data_pagamento) as ano", "id_cliente as cliente_key", "forma_pagamento",
    "status_pagamento", "valor",
    "if(status_pagamento = 'aprovado', valor, cast(0 as decimal(18,2))) as valor_aprovado",
    "parcelas", "1 as quantidade_pagamentos",
)
DELIVERIES = (
    "id_entrega as entrega_key", "id_entrega", "id_pedido",
    day_number("data_envio", "data_envio_key"),
    day_number("data_entrega_prevista", "data_prevista_key"),
    day_number("data_entrega_real", "data_real_key"),
    "data_envio", "year(data_envio) as ano", "id_cliente as cliente_key", "status_entrega",
    "transportadora", "codigo_rastreio",
    "datediff(data_entrega_prevista, data_envio) as prazo_previsto_dias",
    "datediff(data_entrega_real, data_envio) as prazo_real_dias",
    "if(data_entrega_real is not null, "
    "greatest(datediff(data_entrega_real, data_entrega_prevista), 0), null) as atraso_dias",
    f"{ON_TIME} as entrega_no_prazo", "1 as quantidade_entregas",
)
REVIEWS = (
    "id_avaliacao as avaliacao_key", "id_avaliacao", "id_pedido",
    day_number("data_avaliacao", "data_key"), "data_avaliacao",
    "year(data_avaliacao) as ano", "id_cliente as cliente_key", "id_produto as produto_key",
    "nota", "comentario", "nota >= 4 as avaliacao_positiva", "1 as quantidade_avaliacoes",
)


def day_bounds(tables: Tables) -> DataFrame:
    """First and last day per date column, one scan per table, a handful of rows in all."""
    frames = []
    for table, columns in CALENDAR_DAYS.items():
        ends = tables[table].agg(
            *(f(F.col(c).cast("date")).alias(f"{n}_{c}") for c in columns
              for n, f in (("min", F.min), ("max", F.max)))
        )
        spans = F.array(
            *(F.struct(F.lit(table).alias("tabela"), F.lit(c).alias("coluna"),
                       F.col(f"min_{c}").alias("primeiro"), F.col(f"max_{c}").alias("ultimo"))
              for c in columns)
        )
        frames.append(ends.select(F.inline(spans)))
    return reduce(DataFrame.unionByName, frames)


def calendar(tables: Tables) -> DataFrame:
    """Every day between the first and the last one seen, with its attributes."""
    return calendar_between(day_bounds(tables))


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Every day from the first ``primeiro`` to the last ``ultimo``."""
    span = bounds.agg(F.min("primeiro").alias("a"), F.max("ultimo").alias("b"))
    days = span.select(F.explode(F.expr("sequence(a, b, interval 1 day)")).alias("_day"))
    return days.select(*(c.alias(n) for n, c in calendar_columns("_day").items()))


def customers(tables: Tables) -> DataFrame:
    """Documents, e-mail, phone and address stay out of the analytics layer."""
    return tables["clientes"].selectExpr(*CUSTOMER)


def products(tables: Tables) -> DataFrame:
    """Product with its category and supplier; a product without either drops out."""
    category = tables["categorias"].selectExpr(
        "id_categoria", "nome_categoria", "descricao as descricao_categoria"
    )
    supplier = tables["fornecedores"].selectExpr(
        "id_fornecedor", "nome_fornecedor", "estado as estado_fornecedor"
    )
    joined = tables["produtos"].join(category, "id_categoria").join(supplier, "id_fornecedor")
    return joined.selectExpr(*PRODUCT)


def coupons(tables: Tables) -> DataFrame:
    return tables["cupons"].selectExpr(*COUPON)


def _with_order(lines: DataFrame, orders: DataFrame, *columns: str) -> DataFrame:
    """Only header columns a fact needs are shuffled; lines without a header drop out."""
    return lines.join(orders.select("id_pedido", *columns), "id_pedido")


def sales(tables: Tables) -> DataFrame:
    header = ("id_cliente", "data_pedido", "id_cupom", "status")
    return _with_order(tables["itens_pedido"], tables["pedidos"], *header).selectExpr(*SALES)


def payments(tables: Tables) -> DataFrame:
    joined = _with_order(tables["pagamentos"], tables["pedidos"], "id_cliente")
    return joined.selectExpr(*PAYMENTS)


def deliveries(tables: Tables) -> DataFrame:
    joined = _with_order(tables["entregas"], tables["pedidos"], "id_cliente")
    return joined.selectExpr(*DELIVERIES)


def reviews(tables: Tables) -> DataFrame:
    return tables["avaliacoes"].selectExpr(*REVIEWS)


BUILDERS = {
    "dim_tempo": calendar,
    "dim_cliente": customers,
    "dim_produto": products,
    "dim_cupom": coupons,
    "fato_vendas": sales,
    "fato_pagamentos": payments,
    "fato_entregas": deliveries,
    "fato_avaliacoes": reviews,
}


def link_dimensions(fact: DataFrame, model: str, dimensions: Tables) -> DataFrame:
    """Add the surrogate of every linked dimension as of the fact's event date."""
    for link in MODELS[model].links:
        dim = MODELS[link.dimension]
        fact = lookup_as_of(
            fact, dimensions[link.dimension], dim.natural_key, dim.key, link.event,
            MODELS[model].key,
        )
    return fact


def linked(tables: Tables, model: str, dimensions: Tables) -> DataFrame:
    """A fact with the surrogates of its dimensions.

    Keys that sales take from the order are looked up while the data has order grain, so that only
    the product lookup moves item rows.
    """
    if model != "fato_vendas":
        return link_dimensions(BUILDERS[model](tables), model, dimensions)
    header = {"dim_cliente": "id_cliente", "dim_cupom": "id_cupom"}
    orders = tables["pedidos"].select("id_pedido", "data_pedido", "status", *header.values())
    for name, column in header.items():
        dim = MODELS[name]
        keyed = orders.withColumn(dim.natural_key, F.col(column))
        orders = lookup_as_of(keyed, dimensions[name], dim.natural_key, dim.key, "data_pedido", "id_pedido")
        orders = orders.drop(dim.natural_key)
    found = [MODELS[n].key for n in header]
    joined = _with_order(tables["itens_pedido"], orders, "data_pedido", "status", *header.values(), *found)
    sold, product = joined.selectExpr(*SALES, *found), MODELS["dim_produto"]
    sold = lookup_as_of(
        sold, dimensions["dim_produto"], product.natural_key, product.key, "data_pedido", MODELS[model].key)
    keys = [MODELS[link.dimension].key for link in MODELS[model].links]
    return sold.select(*(c for c in sold.columns if c not in keys), *keys)


def with_record_hash(df: DataFrame, name: str = "_gold_record_hash") -> DataFrame:
    return df.withColumn(name, digest(df.columns))
