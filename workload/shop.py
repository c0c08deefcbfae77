"""The shop entities derived from the test tables, as SQL that Spark and DuckDB both run.

``SHOP`` maps an entity to (inputs, SELECT); an input is a test table or another entity and appears
in the text as ``{name}``. Row ids that the tables lack are hashes of the row's content, so no
global numbering is needed. ``hash60(text)`` (the first 60 bits of md5), ``explode_to(condition)``
(0, and 1 where it holds) and ``day_number(date)`` are spelled differently by the two engines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from camadas.entities import ENTITIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_LINE = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(l_quantity as bigint)",
    "cast(floor(l_extendedprice * 100 + 0.5) as bigint)", "cast(floor(l_discount * 100 + 0.5) as bigint)",
    "cast(floor(l_tax * 100 + 0.5) as bigint)", "ascii(l_returnflag)", "ascii(l_linestatus)",
    "day_number(l_shipdate)",
)


def _line_id() -> str:
    """62 bits from all columns of a line: two sums of products, modulo two primes."""

    def residue(base: int, prime: int) -> str:
        terms = (
            f"cast({x} as bigint) % {prime} * {pow(base, i, prime)} % {prime}"
            for i, x in enumerate(_LINE, 1)
        )
        return f"(({' + '.join(terms)}) % {prime})"

    high, low = residue(1103515245, 2147483647), residue(1220703125, 2147483629)
    return f"({high} * 2147483648 + {low} + 1)"


SHOP: dict[str, str] = {
    "clientes": """
        select c_custkey + 1 as id_cliente, c_name as nome,
          concat('c', cast(c_custkey as string), '@example.com') as email,
          lpad(cast(c_custkey + 1 as string), 11, '0') as cpf,
          concat('55', lpad(cast(c_custkey as string), 9, '0')) as telefone,
          date '1950-01-01' + cast(c_custkey * 37 % 18000 as int) as data_nascimento,
          case c_custkey % 3 when 0 then 'M' when 1 then 'F' else 'Outro' end as genero,
          c_mktsegment as logradouro, n_name as cidade, upper(substr(n_name, 1, 2)) as estado,
          lpad(cast(c_custkey as string), 8, '0') as cep,
          date '1995-01-01' + cast(c_custkey % 365 as int) as data_cadastro,
          cast(date '1995-01-01' + cast(c_custkey % 365 as int) as timestamp) as updated_at
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "categorias": """
        select distinct hash60(p_type) as id_categoria, p_type as nome_categoria,
          concat('Type ', p_type) as descricao, timestamp '1995-01-01 00:00:00' as updated_at
        from {part}""",
    "fornecedores": """
        select s_suppkey + 1 as id_fornecedor, s_name as nome_fornecedor,
          lpad(cast(s_suppkey + 1 as string), 14, '0') as cnpj,
          concat('s', cast(s_suppkey as string), '@example.com') as email,
          concat('55', lpad(cast(s_suppkey as string), 9, '0')) as telefone,
          n_name as logradouro, n_name as cidade, upper(substr(n_name, 1, 2)) as estado,
          lpad(cast(s_suppkey as string), 8, '0') as cep,
          timestamp '1995-01-01 00:00:00' as updated_at
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "produtos": """
        select p_partkey + 1 as id_produto, p_name as nome_produto,
          concat(p_name, ' ', p_type) as descricao, cast(p_retailprice as decimal(18,2)) as preco,
          p_partkey * 7 % 500 as estoque, hash60(p_type) as id_categoria,
          p_partkey % (select count(*) from {supplier}) + 1 as id_fornecedor, p_brand as marca,
          cast(p_size as decimal(10,2)) as peso_kg, timestamp '1995-01-01 00:00:00' as updated_at
        from {part}""",
    "cupons": """
        select cast(n_nationkey + 1 as bigint) as id_cupom,
          concat('CUPOM', lpad(cast(n_nationkey as string), 3, '0')) as codigo,
          cast(5 * (n_nationkey % 10 + 1) as bigint) as desconto_percentual,
          cast(50 * (n_nationkey % 6 + 1) as bigint) as valor_minimo,
          date '2001-12-01' + n_nationkey as data_validade, n_nationkey % 2 = 0 as ativo,
          timestamp '1995-01-01 00:00:00' as updated_at
        from {nation}""",
    "pedidos": """
        select o_orderkey + 1 as id_pedido, o_custkey + 1 as id_cliente,
          cast(o_orderdate as date) as data_pedido,
          case when o_orderstatus = 'F' then 'entregue' when o_orderstatus = 'O' then 'enviado'
            when o_orderkey % 3 = 0 then 'pendente' when o_orderkey % 3 = 1 then 'processando'
            else 'cancelado' end as status,
          cast(o_totalprice as decimal(18,2)) as valor_total,
          case when o_orderkey % 4 = 0 then o_orderkey % 25 + 1 end as id_cupom,
          cast(o_orderdate as timestamp) as updated_at
        from {orders}""",
    "itens_pedido": f"""
        select {_line_id()} as id_item, l_orderkey + 1 as id_pedido, l_partkey + 1 as id_produto,
          cast(l_quantity as bigint) as quantidade, cast(price as decimal(18,2)) as valor_unitario,
          cast(percent as decimal(5,2)) as desconto_percentual,
          cast(cast(cast(l_quantity as bigint) as decimal(6,0)) * price
            * (100 - cast(percent as decimal(3,0))) * 0.01 as decimal(18,2)) as subtotal,
          cast(l_shipdate as timestamp) as updated_at
        from (select *, cast(floor(l_discount * 100 + 0.5) as bigint) as percent
            from {{lineitem}}) as l
          join (select p_partkey, cast(p_retailprice as decimal(10,2)) as price from {{part}}) as p
          on l_partkey = p_partkey""",
    "pagamentos": """
        select o_orderkey + 1 + dup * 1000000000 as id_pagamento, o_orderkey + 1 as id_pedido,
          case o_orderkey % 4 when 0 then 'cartao_credito' when 1 then 'cartao_debito'
            when 2 then 'pix' else 'boleto' end as forma_pagamento,
          case when o_orderkey % 10 <= 7 then 'aprovado' when o_orderkey % 10 = 8 then 'pendente'
            else 'recusado' end as status_pagamento,
          cast(o_totalprice as decimal(18,2)) as valor,
          cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as data_pagamento,
          case when o_orderkey % 4 = 0 then o_orderkey % 12 + 1 else cast(1 as bigint) end
            as parcelas,
          cast(cast(o_orderdate as date) + cast(o_orderkey % 5 + dup as int) as timestamp)
            as updated_at
        from (select *, explode_to(o_orderkey % 10 = 0) as dup from {orders}) as o""",
    "entregas": """
        select o_orderkey + 1 as id_entrega, o_orderkey + 1 as id_pedido,
          case when o_orderstatus = 'F' then 'entregue' when o_orderkey % 20 = 0 then 'devolvido'
            when o_orderstatus = 'O' then 'em_transito' else 'pendente' end as status_entrega,
          envio as data_envio, envio + cast(3 + o_orderkey % 18 as int) as data_entrega_prevista,
          case when o_orderstatus = 'F'
              then envio + cast(3 + o_orderkey % 18 + o_orderkey % 8 - 2 as int)
            when o_orderkey % 20 = 0 then envio + cast(13 + o_orderkey % 18 as int) end
            as data_entrega_real,
          case o_orderkey % 8 when 0 then 'Correios' when 1 then 'JadLog' when 2 then
            'Total Express' when 3 then 'Loggi' when 4 then 'Azul Cargo' when 5 then 'Latam Cargo'
            when 6 then 'DHL' else 'FedEx' end as transportadora,
          concat('AA', lpad(cast(o_orderkey as string), 9, '0'), 'BR') as codigo_rastreio,
          cast(envio as timestamp) as updated_at
        from {orders} join (
          select l_orderkey, min(cast(l_shipdate as date)) as envio from {lineitem}
          group by l_orderkey) as s on o_orderkey = l_orderkey""",
    "avaliacoes": """
        select event_id + 1 as id_avaliacao,
          event_id % (select count(*) from {orders}) + 1 as id_pedido,
          user_id % (select count(*) from {customer}) + 1 as id_cliente,
          event_id % (select count(*) from {part}) + 1 as id_produto, event_id % 5 + 1 as nota,
          event_type as comentario, cast(ts as date) as data_avaliacao,
          cast(ts as timestamp) as updated_at
        from {events}""",
    # --- defective inputs, derived with modulo arithmetic ---------------------------------
    # raw orders: padded and upper-case texts, bad fields, orphans, null keys, older and newer copies
    "pedidos_brutos": """
        select case when id_pedido % 103 = 0 then null else id_pedido end as id_pedido,
          case when id_pedido % 89 = 0 then id_cliente + 1000000000 else id_cliente end
            as id_cliente,
          case when id_pedido % 97 = 0 then null else data_pedido end as data_pedido,
          case when id_pedido % 79 = 0 then '   ' when id_pedido % 5 = 0
            then concat(' ', upper(status), '  ') else status end as status,
          case when id_pedido % 83 = 0 then -valor_total else valor_total end as valor_total,
          case when id_pedido % 36 = 1 then 999 else id_cupom end as id_cupom, updated_at,
          'b' as origem
        from {pedidos}
        union all
        select id_pedido, id_cliente, data_pedido, 'pendente' as status, valor_total, id_cupom,
          updated_at - interval 1 day as updated_at, 'a' as origem
        from {pedidos} where id_pedido % 7 = 0
        union all
        select id_pedido, id_cliente, data_pedido, 'desconhecido' as status, valor_total, id_cupom,
          updated_at + interval 1 day as updated_at, 'c' as origem
        from {pedidos} where id_pedido % 101 = 0
        union all
        select null as id_pedido, id_cliente, data_pedido, status, valor_total, id_cupom,
          updated_at, 'd' as origem
        from {pedidos} where id_pedido % 103 = 0 and id_pedido % 97 <> 0 and id_pedido % 89 <> 0
          and id_pedido % 83 <> 0 and id_pedido % 79 <> 0 and id_pedido % 36 <> 1
          and id_pedido % 5 <> 0""",
    # raw customers: a third of them share one cpf, others share it in pairs, bad patterns
    "clientes_brutos": """
        select id_cliente, concat(' ', nome, ' ') as nome,
          case when id_cliente % 89 = 0 then 'no-mail' else upper(email) end as email,
          case when id_cliente % 3 = 0 then '000.000.000-01' when id_cliente % 10 = 0
            then lpad(cast(id_cliente + 1 as string), 11, '0')
            else concat(substr(cpf, 1, 3), '.', substr(cpf, 4, 3), '.', substr(cpf, 7, 3), '-',
              substr(cpf, 10, 2)) end as cpf,
          concat('+', telefone) as telefone, data_nascimento,
          case when id_cliente % 83 = 0 then 'X' else genero end as genero, logradouro, cidade,
          case when id_cliente % 79 = 0 then 'B1' else lower(estado) end as estado, cep,
          data_cadastro, updated_at
        from {clientes}""",
    # raw rows that break the source-side contract: texts too long, values outside their domain or range
    "fornecedores_brutos": """
        select id_fornecedor, nome_fornecedor, cnpj, email, telefone, logradouro, cidade,
          case when id_fornecedor % 4 = 0 then concat(estado, 'X') else estado end as estado, cep,
          updated_at
        from {fornecedores}""",
    "pagamentos_brutos": """
        select id_pagamento, id_pedido,
          case when id_pagamento % 41 = 0 then 'dinheiro' else forma_pagamento end as forma_pagamento,
          status_pagamento, valor, data_pagamento,
          case when id_pagamento % 37 = 0 then 13 else parcelas end as parcelas, updated_at
        from {pagamentos}""",
    "entregas_brutos": """
        select id_entrega, id_pedido, status_entrega, data_envio, data_entrega_prevista, data_entrega_real,
          case when id_entrega % 31 = 0 then 'Outra' else transportadora end as transportadora,
          codigo_rastreio, updated_at
        from {entregas}""",
    "avaliacoes_brutos": """
        select id_avaliacao, id_pedido, id_cliente, id_produto,
          case when id_avaliacao % 23 = 0 then 6 else nota end as nota,
          case when id_avaliacao % 29 = 0 then null else comentario end as comentario, data_avaliacao,
          updated_at
        from {avaliacoes}""",
    # newer versions: most holders of the shared cpf leave it, others join a held one or turn invalid
    "clientes_corrigidos": """
        select id_cliente, nome,
          case when id_cliente % 97 = 0 then 'no-mail' else email end as email,
          case when id_cliente % 3 = 0 then lpad(cast(id_cliente + 90000000000 as string), 11, '0')
            when id_cliente % 7 = 0 then '00000000001' else lpad(cast(id_cliente + 1 as string), 11, '0') end as cpf,
          telefone, data_nascimento, genero, logradouro, cidade, estado, cep, data_cadastro,
          updated_at + interval 1 day as updated_at
        from {clientes} where id_cliente % 365 >= 300 or id_cliente % 11 = 0""",
    # parents with gaps, so that some references dangle
    "clientes_parciais": "select * from {clientes} where id_cliente % 10 <> 3",
    "cupons_parciais": "select * from {cupons} where id_cupom % 10 <> 3",
    # the state before a merge: four fifths of the orders, with older, newer and equal versions
    "pedidos_antes": """
        select id_pedido, id_cliente, data_pedido,
          case when id_pedido % 2 = 0 then 'pendente' else status end as status, valor_total,
          id_cupom,
          case when id_pedido % 3 = 0 then updated_at - interval 2 day
            when id_pedido % 11 = 0 then updated_at + interval 2 day else updated_at end
            as updated_at
        from {pedidos} where id_pedido % 5 <> 0""",
    "pedidos_lote": "select * from {pedidos} where id_pedido % 17 <> 0",
    # the second load of a versioned dimension: moved, new and missing customers
    "clientes_depois": """
        select id_cliente, nome, email, cpf, telefone, data_nascimento, genero, logradouro,
          case when id_cliente % 6 = 0 then concat(cidade, ' 2') else cidade end as cidade, estado,
          cep, data_cadastro, updated_at
        from {clientes} where id_cliente % 13 <> 0
        union all
        select id_cliente + 1000000000 as id_cliente, nome, email, cpf, telefone, data_nascimento,
          genero, logradouro, cidade, estado, cep, data_cadastro, updated_at
        from {clientes} where id_cliente % 50 = 0""",
}

# --- a second cycle: changes of all ten collections, and rows that the first load lacked -------------
# ``<entity>_2`` is the second batch, ``<entity>_fim`` what is known after it. The first load is what is not HELD.
HELD = "id_pedido % 16 = 5"


def _second(table: str, where: str, **changed: str) -> str:
    changed["updated_at"] = "updated_at + interval 40 year"
    columns = (f"{changed[c]} as {c}" if c in changed else c for c in ENTITIES[table].columns)
    return f"select {', '.join(columns)} from {{{table}}} where {where}"


def _after(table: str) -> str:
    key, columns = ENTITIES[table].key, ", ".join(ENTITIES[table].columns)
    return (f"select {columns} from {{{table}}} where {key} not in (select {key} from {{{table}_2}})"
            f" union all select {columns} from {{{table}_2}}")


SHOP |= {
    "clientes_2": _second("clientes", "id_cliente % 6 = 0", cidade="concat(cidade, ' 2')") + " union all " + _second(
        "clientes", "id_cliente % 50 = 0", id_cliente="id_cliente + 1000000000", cpf="concat('9', substr(cpf, 2))"),
    "categorias_2": _second("categorias", "id_categoria % 7 = 0", descricao="concat(descricao, ' 2')"),
    "fornecedores_2": _second("fornecedores", "id_fornecedor % 9 = 0", estado="'ZZ'"),
    "produtos_2": _second("produtos", "id_produto % 50 = 0", preco="cast(preco + 1 as decimal(18,2))"),
    "cupons_2": _second("cupons", "id_cupom % 5 = 0", ativo="not ativo"),
    "pedidos_2": _second(
        "pedidos", f"id_pedido % 24 = 0 or {HELD}", status="case when id_pedido % 24 = 0 then 'cancelado' else status end",
        data_pedido="case when id_pedido % 48 = 0 then data_pedido + cast(400 as int) else data_pedido end"),
    "itens_pedido_2": _second(
        "itens_pedido", f"id_item % 20 = 0 or {HELD}",
        quantidade="case when id_item % 20 = 0 then quantidade + 1 else quantidade end"),
    "pagamentos_2": _second(
        "pagamentos", f"id_pagamento % 30 = 7 or {HELD}",
        valor="case when id_pagamento % 30 = 7 then cast(valor + 1 as decimal(18,2)) else valor end"),
    "entregas_2": _second(
        "entregas", f"id_entrega % 25 = 0 or {HELD}",
        data_entrega_prevista="data_entrega_prevista + cast(case when id_entrega % 25 = 0 then 1 else 0 end as int)"),
    "avaliacoes_2": _second(
        "avaliacoes", f"id_avaliacao % 15 = 0 or {HELD}",
        nota="case when id_avaliacao % 15 = 0 then 6 - nota else nota end"),
}
SHOP |= {f"{t}_fim": _after(t) for t in ENTITIES}

_HASH = {
    "spark": "cast(conv(substr(md5({0}), 1, 15), 16, 10) as bigint)",
    "duckdb": "cast(concat('0x', substr(md5({0}), 1, 15)) as bigint)",
}
_COPIES = {
    "spark": "explode(if({0}, array(0L, 1L), array(0L)))",
    "duckdb": "unnest(case when {0} then [0::bigint, 1::bigint] else [0::bigint] end)",
}


_DAY_NUMBER = {
    "spark": "unix_date(cast({0} as date))",
    "duckdb": "(cast({0} as date) - date '1970-01-01')",
}


def _call(text: str, name: str, template: str) -> str:
    """Replace ``name(arg)`` by the dialect's form; arguments may hold nested parentheses."""
    while (start := text.find(name + "(")) >= 0:
        depth, end = 0, start + len(name)
        while True:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            if depth == 0:
                break
            end += 1
        arg = text[start + len(name) + 1 : end]
        text = text[:start] + template.format(arg) + text[end + 1 :]
    return text


def _dialect(text: str, engine: str) -> str:
    for name, forms in (("hash60", _HASH), ("explode_to", _COPIES), ("day_number", _DAY_NUMBER)):
        text = _call(text, name, forms[engine])
    return text


def _inputs(text: str) -> list[str]:
    return sorted(set(re.findall(r"{(\w+)}", text.replace("{{", "").replace("}}", ""))))


class Shop:
    """Entities of one test-data folder, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._known = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in SHOP:
                text = _dialect(SHOP[name], "spark")
                inputs = {i: self[i] for i in _inputs(text)}
                self._known[name] = self.spark.sql(text, **inputs)
            else:
                self._known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._known[name]


def with_shop(sql: str) -> str:
    """Prefix a DuckDB query, which names entities as ``{entity}``, with the CTEs it needs."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in SHOP and name not in needed:
            for i in _inputs(SHOP[name]):
                visit(i)
            needed.append(name)

    for name in _inputs(sql):
        visit(name)
    ctes = ", ".join(f"{n} as ({_plain(_dialect(SHOP[n], 'duckdb'))})" for n in needed)
    body = _plain(_dialect(sql, "duckdb")).strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"


def _plain(sql: str) -> str:
    """Names for placeholders; a doubled brace is a literal one."""
    text = sql.replace("{{", "\x01").replace("}}", "\x02")
    return re.sub(r"{(\w+)}", r"\1", text).replace("\x01", "{").replace("\x02", "}")
