"""The ten shop entities and eight star-schema models, as contracts."""

from __future__ import annotations

from camadas.contracts import Entity, Field, Link, Model, Reference, Unique

# Patterns, domains, limits and sentinels that define the data model.
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
CPF = r"^\d{11}$"
CNPJ = r"^\d{14}$"
PHONE = r"^\d{10,13}$"
POSTCODE = r"^\d{8}$"
STATE = r"^[A-Z]{2}$"
TRACKING = r"^[A-Z]{2}\d{9}BR$"
GENDERS = ("M", "F", "Outro")
ORDER_STATUS = ("pendente", "processando", "enviado", "entregue", "cancelado")
PAYMENT_METHODS = ("cartao_credito", "cartao_debito", "pix", "boleto")
PAYMENT_STATUS = ("aprovado", "pendente", "recusado", "estornado")
DELIVERY_STATUS = ("pendente", "em_transito", "entregue", "devolvido")
CARRIERS = (
    "Correios", "JadLog", "Total Express", "Loggi", "Azul Cargo", "Latam Cargo", "DHL", "FedEx",
)
CPF_RULE = "CPF deve ser unico entre clientes — mantido o registro com updated_at mais recente"
APPROVED_RULE = (
    "Cada pedido pode ter no maximo um pagamento com status aprovado — "
    "mantido o registro com updated_at mais recente"
)
# source-side document rules that go beyond presence, type and domain
DOCUMENT_RANGES = {"nota": (1, 5), "parcelas": (1, 12)}
DOCUMENT_LENGTHS = {"estado": (2, 2)}
WATERMARK = "updated_at"
OVERLAP_HOURS = 24
BEGIN_OF_TIME = "1900-01-01 00:00:00"
END_OF_TIME = "9999-12-31 23:59:59"


def _id(name, required=True):
    return Field(name, "integer", "bigint", required=required, low=1)


def _whole(name, low=None, high=None):
    return Field(name, "integer", "bigint", low=low, high=high)


def _decimal(name, digits="18,2", high=None):
    return Field(name, "number", f"decimal({digits})", low=0, high=high)


def _text(name, clean="trim", **rules):
    return Field(name, "string", "string", clean=clean, **rules)


def _day(name, required=True):
    return Field(name, "date", "date", required=required)


_CHANGED = Field(WATERMARK, "date", "timestamp")
_PLACE = (
    _text("logradouro"), _text("cidade"), _text("estado", "upper", pattern=STATE),
    _text("cep", "digits", pattern=POSTCODE),
)
_CONTACT = (_text("email", "lower", pattern=EMAIL), _text("telefone", "digits", pattern=PHONE))


_ENTITIES = (
    Entity(
        "clientes", "id_cliente",
        (
            _id("id_cliente"), _text("nome"), _CONTACT[0], _text("cpf", "digits", pattern=CPF),
            _CONTACT[1], _day("data_nascimento"), _text("genero", one_of=GENDERS), *_PLACE,
            _day("data_cadastro"), _CHANGED,
        ),
        unique=(Unique(("cpf",), "cpf_duplicado", CPF_RULE),),
    ),
    Entity(
        "categorias", "id_categoria",
        (_id("id_categoria"), _text("nome_categoria"), _text("descricao"), _CHANGED),
    ),
    Entity(
        "fornecedores", "id_fornecedor",
        (
            _id("id_fornecedor"), _text("nome_fornecedor"), _text("cnpj", "digits", pattern=CNPJ),
            *_CONTACT, *_PLACE, _CHANGED,
        ),
    ),
    Entity(
        "produtos", "id_produto",
        (
            _id("id_produto"), _text("nome_produto"), _text("descricao"), _decimal("preco"),
            _whole("estoque", 0), _id("id_categoria"), _id("id_fornecedor"), _text("marca"),
            _decimal("peso_kg", "10,2"), _CHANGED,
        ),
        references=(
            Reference("id_categoria", "categorias", "id_categoria"),
            Reference("id_fornecedor", "fornecedores", "id_fornecedor"),
        ),
    ),
    Entity(
        "cupons", "id_cupom",
        (
            _id("id_cupom"), _text("codigo", "upper"), _whole("desconto_percentual", 0, 100),
            _whole("valor_minimo", 0), _day("data_validade"),
            Field("ativo", "boolean", "boolean"), _CHANGED,
        ),
    ),
    Entity(
        "pedidos", "id_pedido",
        (
            _id("id_pedido"), _id("id_cliente"), _day("data_pedido"),
            _text("status", "lower", one_of=ORDER_STATUS), _decimal("valor_total"),
            _id("id_cupom", required=False), _CHANGED,
        ),
        references=(
            Reference("id_cliente", "clientes", "id_cliente"),
            Reference("id_cupom", "cupons", "id_cupom", required=False),
        ),
    ),
    Entity(
        "itens_pedido", "id_item",
        (
            _id("id_item"), _id("id_pedido"), _id("id_produto"), _whole("quantidade", 1),
            _decimal("valor_unitario"), _decimal("desconto_percentual", "5,2", high=100),
            _decimal("subtotal"), _CHANGED,
        ),
        references=(
            Reference("id_pedido", "pedidos", "id_pedido"),
            Reference("id_produto", "produtos", "id_produto"),
        ),
    ),
    Entity(
        "pagamentos", "id_pagamento",
        (
            _id("id_pagamento"), _id("id_pedido"),
            _text("forma_pagamento", "lower", one_of=PAYMENT_METHODS),
            _text("status_pagamento", "lower", one_of=PAYMENT_STATUS), _decimal("valor"),
            _day("data_pagamento"), _whole("parcelas", 1, 12), _CHANGED,
        ),
        references=(Reference("id_pedido", "pedidos", "id_pedido"),),
        unique=(
            Unique(
                ("id_pedido",), "pagamento_duplicado_aprovado", APPROVED_RULE,
                "status_pagamento", "aprovado",
            ),
        ),
    ),
    Entity(
        "entregas", "id_entrega",
        (
            _id("id_entrega"), _id("id_pedido"),
            _text("status_entrega", "lower", one_of=DELIVERY_STATUS), _day("data_envio"),
            _day("data_entrega_prevista"), _day("data_entrega_real", required=False),
            _text("transportadora", one_of=CARRIERS),
            _text("codigo_rastreio", "upper", pattern=TRACKING), _CHANGED,
        ),
        references=(Reference("id_pedido", "pedidos", "id_pedido"),),
    ),
    Entity(
        "avaliacoes", "id_avaliacao",
        (
            _id("id_avaliacao"), _id("id_pedido"), _id("id_cliente"), _id("id_produto"),
            _whole("nota", 1, 5), _text("comentario"), _day("data_avaliacao"), _CHANGED,
        ),
        references=(
            Reference("id_pedido", "pedidos", "id_pedido"),
            Reference("id_cliente", "clientes", "id_cliente"),
            Reference("id_produto", "produtos", "id_produto"),
        ),
    ),
)

ENTITIES: dict[str, Entity] = {e.name: e for e in _ENTITIES}


def _type2(name, noun, sources):
    return Model(
        name, "dimension", f"{noun}_sk", sources, history="type2", natural_key=f"{noun}_key"
    )


_MODELS = (
    Model(
        "dim_tempo", "dimension", "data_key",
        ("clientes", "cupons", "pedidos", "pagamentos", "entregas", "avaliacoes"),
        history="static",
    ),
    _type2("dim_cliente", "cliente", ("clientes",)),
    _type2("dim_produto", "produto", ("produtos", "categorias", "fornecedores")),
    _type2("dim_cupom", "cupom", ("cupons",)),
    Model(
        "fato_vendas", "fact", "venda_key", ("itens_pedido", "pedidos"), partition=("ano",),
        links=(
            Link("dim_cliente", "data_pedido"),
            Link("dim_produto", "data_pedido"),
            Link("dim_cupom", "data_pedido"),
        ),
    ),
    Model(
        "fato_pagamentos", "fact", "pagamento_key", ("pagamentos", "pedidos"), partition=("ano",),
        links=(Link("dim_cliente", "data_pagamento"),),
    ),
    Model(
        "fato_entregas", "fact", "entrega_key", ("entregas", "pedidos"), partition=("ano",),
        links=(Link("dim_cliente", "data_envio"),),
    ),
    Model(
        "fato_avaliacoes", "fact", "avaliacao_key", ("avaliacoes",), partition=("ano",),
        links=(Link("dim_cliente", "data_avaliacao"), Link("dim_produto", "data_avaliacao")),
    ),
)

MODELS: dict[str, Model] = {m.name: m for m in _MODELS}
