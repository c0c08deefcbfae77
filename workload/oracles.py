"""DuckDB twins of the registered queries, written against the shop entities."""

from __future__ import annotations

from camadas.sources.synthetic import BAD, GOOD, NEUTRAL
from workload.shop import with_shop

_SQL: dict[str, str] = {}

# --- star schema and marts ------------------------------------------------------------------

_SQL["fact_sales"] = """
select i.id_item as venda_key, i.id_item, p.id_pedido,
  cast(strftime(p.data_pedido, '%Y%m%d') as bigint) as data_key, p.data_pedido,
  year(p.data_pedido) as ano, p.id_cliente as cliente_key, i.id_produto as produto_key,
  p.id_cupom as cupom_key, p.status as status_pedido, i.quantidade, i.valor_unitario,
  i.desconto_percentual, cast(i.quantidade * i.valor_unitario as decimal(18,2)) as valor_bruto,
  cast(i.quantidade * i.valor_unitario - i.subtotal as decimal(18,2)) as valor_desconto,
  i.subtotal as receita_liquida, 1::bigint as quantidade_itens_registro
from {itens_pedido} i join {pedidos} p using (id_pedido)"""

_SQL["fact_payments"] = """
select g.id_pagamento as pagamento_key, g.id_pagamento, p.id_pedido,
  cast(strftime(g.data_pagamento, '%Y%m%d') as bigint) as data_key, g.data_pagamento,
  year(g.data_pagamento) as ano, p.id_cliente as cliente_key, g.forma_pagamento,
  g.status_pagamento, g.valor,
  case when g.status_pagamento = 'aprovado' then g.valor else 0 end as valor_aprovado, g.parcelas,
  1::bigint as quantidade_pagamentos
from {pagamentos} g join {pedidos} p using (id_pedido)"""

_SQL["fact_deliveries"] = """
select e.id_entrega as entrega_key, e.id_entrega, p.id_pedido,
  cast(strftime(e.data_envio, '%Y%m%d') as bigint) as data_envio_key,
  cast(strftime(e.data_entrega_prevista, '%Y%m%d') as bigint) as data_prevista_key,
  cast(strftime(e.data_entrega_real, '%Y%m%d') as bigint) as data_real_key, e.data_envio,
  year(e.data_envio) as ano, p.id_cliente as cliente_key, e.status_entrega, e.transportadora,
  e.codigo_rastreio, e.data_entrega_prevista - e.data_envio as prazo_previsto_dias,
  e.data_entrega_real - e.data_envio as prazo_real_dias,
  case when e.data_entrega_real is not null
    then greatest(e.data_entrega_real - e.data_entrega_prevista, 0) end as atraso_dias,
  case when e.data_entrega_real is not null
    then e.data_entrega_real <= e.data_entrega_prevista end as entrega_no_prazo,
  1::bigint as quantidade_entregas
from {entregas} e join {pedidos} p using (id_pedido)"""

_SQL["fact_reviews"] = """
select id_avaliacao as avaliacao_key, id_avaliacao, id_pedido,
  cast(strftime(data_avaliacao, '%Y%m%d') as bigint) as data_key, data_avaliacao,
  year(data_avaliacao) as ano, id_cliente as cliente_key, id_produto as produto_key, nota,
  comentario, nota >= 4 as avaliacao_positiva, 1::bigint as quantidade_avaliacoes
from {avaliacoes}"""

_SQL["dim_customer"] = """
select id_cliente as cliente_key, nome, genero, data_nascimento, cidade, estado, data_cadastro
from {clientes}"""

_SQL["dim_product"] = """
select p.id_produto as produto_key, p.nome_produto, p.descricao as descricao_produto, p.marca,
  p.preco, p.estoque, p.peso_kg, c.id_categoria as categoria_key, c.nome_categoria,
  c.descricao as descricao_categoria, f.id_fornecedor as fornecedor_key, f.nome_fornecedor,
  f.estado as estado_fornecedor
from {produtos} p join {categorias} c using (id_categoria)
  join {fornecedores} f using (id_fornecedor)"""

_SQL["dim_coupon"] = """
select id_cupom as cupom_key, codigo, desconto_percentual, valor_minimo, data_validade, ativo
from {cupons}"""

_DAYS = """
  select 'clientes' as tabela, 'data_cadastro' as coluna, data_cadastro as data from {clientes}
  union all select 'cupons', 'data_validade', data_validade from {cupons}
  union all select 'pedidos', 'data_pedido', data_pedido from {pedidos}
  union all select 'pagamentos', 'data_pagamento', data_pagamento from {pagamentos}
  union all select 'entregas', 'data_envio', data_envio from {entregas}
  union all select 'entregas', 'data_entrega_prevista', data_entrega_prevista from {entregas}
  union all select 'entregas', 'data_entrega_real', data_entrega_real from {entregas}
  union all select 'avaliacoes', 'data_avaliacao', data_avaliacao from {avaliacoes}"""

_SQL["dim_calendar"] = f"""
with dias as ({_DAYS}),
datas as (select unnest(generate_series(min(data), max(data), interval 1 day))::date as data
  from dias)
select cast(strftime(data, '%Y%m%d') as bigint) as data_key, data, year(data) as ano,
  case when month(data) <= 6 then 1 else 2 end as semestre, quarter(data) as trimestre,
  month(data) as mes,
  ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro',
   'Novembro','Dezembro'][month(data)] as mes_nome,
  strftime(data, '%Y-%m') as ano_mes, weekofyear(data) as semana_ano, day(data) as dia_mes,
  dayofweek(data) + 1 as dia_semana_numero,
  ['Domingo','Segunda-feira','Terça-feira','Quarta-feira','Quinta-feira','Sexta-feira',
   'Sábado'][dayofweek(data) + 1] as dia_semana_nome,
  dayofweek(data) in (0, 6) as fim_de_semana
from datas"""

_SQL["date_bounds"] = f"""
select tabela, coluna, min(data) as primeiro, max(data) as ultimo from ({_DAYS}) as d
group by tabela, coluna"""

_SQL["date_spine_union"] = f"""
select data, count(*) as ocorrencias from ({_DAYS}) as d where data is not null group by data"""

_SQL["date_key"] = """
select id_pedido, year(data_pedido) * 10000 + month(data_pedido) * 100 + day(data_pedido)
  as data_key from {pedidos}"""

_FLAT = """
  select i.id_item, p.id_pedido, p.data_pedido, year(p.data_pedido) as ano,
    strftime(p.data_pedido, '%Y-%m') as ano_mes, p.status as status_pedido, c.nome as cliente,
    c.cidade, c.estado, r.nome_produto as produto, k.nome_categoria as categoria, r.marca,
    u.codigo as cupom, i.quantidade, i.valor_unitario,
    cast(i.quantidade * i.valor_unitario as decimal(18,2)) as valor_bruto,
    cast(i.quantidade * i.valor_unitario - i.subtotal as decimal(18,2)) as valor_desconto,
    i.subtotal as receita_liquida, g.forma_pagamento, g.status_pagamento, e.status_entrega,
    case when e.data_entrega_real is not null
      then e.data_entrega_real <= e.data_entrega_prevista end as entrega_no_prazo
  from {itens_pedido} i join {pedidos} p on i.id_pedido = p.id_pedido
    left join {clientes} c on p.id_cliente = c.id_cliente
    left join {produtos} r on i.id_produto = r.id_produto
    left join {categorias} k on r.id_categoria = k.id_categoria
    left join {cupons} u on p.id_cupom = u.id_cupom
    left join (select *, row_number() over (partition by id_pedido order by id_pagamento) as n
      from {pagamentos}) g on g.id_pedido = p.id_pedido and g.n = 1
    left join (select *, row_number() over (partition by id_pedido order by id_entrega) as n
      from {entregas}) e on e.id_pedido = p.id_pedido and e.n = 1"""

_KPI = """
  sum(receita_liquida) as faturamento_total, count(distinct id_pedido) as qtd_pedidos,
  round(cast(sum(receita_liquida) as double) / count(distinct id_pedido), 4) as ticket_medio,
  round(cast(count(distinct case when status_entrega = 'entregue' then id_pedido end) as double)
    / nullif(count(distinct case when status_entrega <> '' then id_pedido end), 0), 4)
    as pct_entregues"""

_SQL["obt_sales"] = _FLAT
_SQL["first_per_order"] = """
select id_pedido, forma_pagamento, status_pagamento, valor from {pagamentos}
qualify row_number() over (partition by id_pedido order by id_pagamento) = 1"""
_SQL["kpi_headline"] = f"select {_KPI} from ({_FLAT}) as f"
_SQL["kpi_filtered"] = f"""
select {_KPI} from ({_FLAT}) as f
where ano_mes between '1997-01' and '1997-12' and categoria in ('ECONOMY', 'STANDARD', 'PROMO')
  and estado in ('BR', 'AR', 'CA', 'UN', 'NA')
  and forma_pagamento in ('pix', 'boleto', 'cartao_credito')"""
_SQL["revenue_by_month"] = f"""
select ano_mes, sum(receita_liquida) as faturamento from ({_FLAT}) as f group by ano_mes"""
_SQL["top_products"] = f"""
select produto, sum(quantidade)::bigint as quantidade from ({_FLAT}) as f group by produto
order by 2 desc, 1 limit 10"""

_SALES = "(" + _SQL["fact_sales"] + ") as v"
_SQL["sales_rows_by_year"] = f"select ano, count(*) as linhas from {_SALES} group by ano"
_SQL["ind_revenue"] = f"""
select sum(valor_bruto) as receita_bruta, sum(receita_liquida) as receita_liquida,
  sum(valor_desconto) as valor_desconto,
  round(cast(sum(valor_desconto) * 100 as double) / sum(valor_bruto), 4) as pct_desconto
from {_SALES}"""
_SQL["ind_orders"] = f"""
select sum(quantidade)::bigint as itens_vendidos, count(distinct id_pedido) as pedidos_distintos,
  round(cast(sum(receita_liquida) as double) / count(distinct id_pedido), 4) as ticket_medio
from {_SALES}"""
_AXES = {
    "mes": "strftime(v.data_pedido, '%Y-%m')", "cliente": "c.nome", "produto": "p.nome_produto",
    "marca": "p.marca", "categoria": "p.nome_categoria", "fornecedor": "p.nome_fornecedor",
}
_SQL["ind_revenue_by_axis"] = " union all ".join(
    f"select '{axis}' as eixo, {value} as valor, sum(v.receita_liquida) as receita_liquida"
    f" from {_SALES} left join {{clientes}} c on c.id_cliente = v.cliente_key"
    f" left join ({_SQL['dim_product']}) p on p.produto_key = v.produto_key group by {value}"
    for axis, value in _AXES.items()
)
_SQL["ind_payments"] = f"""
select forma_pagamento, status_pagamento, sum(valor_aprovado) as valor_aprovado,
  count(*) as pagamentos from ({_SQL['fact_payments']}) as g group by all"""
_SQL["ind_deliveries"] = f"""
select round(avg(prazo_real_dias), 4) as prazo_medio_dias,
  sum(atraso_dias)::bigint as dias_de_atraso,
  round(100.0::double * count(*) filter (entrega_no_prazo) / count(entrega_no_prazo), 4)
    as pct_no_prazo
from ({_SQL['fact_deliveries']}) as e"""
_SQL["ind_reviews"] = f"""
select round(avg(nota), 4) as nota_media,
  round(100.0::double * count(*) filter (avaliacao_positiva) / count(*), 4) as pct_positivas
from ({_SQL['fact_reviews']}) as a"""

# --- decode, normalise, hash ------------------------------------------------------------------

_ORDERS = """
  select id_pedido, id_cliente, data_pedido, lower(trim(status)) as status,
    cast(valor_total as decimal(18,2)) as valor_total, cast(id_cupom as bigint) as id_cupom,
    updated_at, origem from {pedidos_brutos}"""

_SQL["json_decode"] = _ORDERS
_SQL["ext_json_encode"] = """
select concat('{{"id_pedido":{{"$numberLong":"', id_pedido, '"}},"id_cliente":{{"$numberLong":"',
  id_cliente, '"}},"data_pedido":{{"$date":{{"$numberLong":"', epoch_ms(data_pedido),
  '"}}}},"status":"', status, '","valor_total":{{"$numberDouble":"', valor_total,
  '"}},"id_cupom":', case when id_cupom is null then 'null'
    else concat('{{"$numberLong":"', id_cupom, '"}}') end,
  ',"updated_at":{{"$date":{{"$numberLong":"', epoch_ms(updated_at), '"}}}}}}') as raw_document
from {pedidos}"""
_SQL["ext_json_round_trip"] = "select * from {entregas}"
_SQL["ext_number"] = """
select o_orderkey, case when o_orderkey % 17 <> 0 then o_orderkey end as inteiro,
  case when o_orderkey % 17 <> 0 then cast(o_orderkey as decimal(18,2))
    + case when o_orderkey % 3 = 2 then 0.70 else 0 end end as decimal
from {orders}"""
_SQL["ext_date"] = """
select o_orderkey, make_timestamp(trunc(ms / 1000.0)::bigint * 1000000) as instante,
  make_timestamp(trunc(ms / 1000.0)::bigint * 1000000)::date as dia
from (select o_orderkey, case when o_orderkey % 2 = 0 then -o_orderkey else o_orderkey end
  * 86399999 as ms from {orders}) as o"""
_SQL["normalize_strings"] = r"""
select c_custkey, trim(x) as aparado, lower(trim(x)) as minusculo, upper(trim(x)) as maiusculo,
  regexp_replace(x, '[^0-9]', '', 'g') as digitos
from (select c_custkey, concat('  ', c_name, ' - ', c_mktsegment, chr(9), ' ') as x
  from {customer}) as c"""
_SQL["cell_coercion"] = """
select o_orderkey, case when o_orderkey % 4 in (1, 3) then o_orderkey end as inteiro,
  case when o_orderkey % 5 <> 3 then o_orderkey % 5 < 3 end as logico,
  case when o_orderkey % 3 <> 0 then o_orderkey + 0.25::double end as numero,
  case when o_orderkey % 7 > 1 then cast(cast(o_orderdate as date) as timestamp) end as data
from {orders}"""
_SQL["record_hash"] = """
select id_produto, sha256(concat('{{"id_produto":', id_produto, ',"nome_produto":"', nome_produto,
  '","marca":"', marca, '","estoque":', estoque, '}}')) as hash from {produtos}"""
_SQL["surrogate_keys"] = """
select id_cliente, sha256(concat(id_cliente, '||', strftime(updated_at, '%Y-%m-%d %H:%M:%S'),
  '.000')) as cliente_sk from {clientes}"""

# --- quality ------------------------------------------------------------------------------------

_NEWEST = f"""
  select * from ({_ORDERS}) as o
  qualify row_number() over (
    partition by case when id_pedido is null then md5(concat_ws('|', id_cliente, data_pedido,
      status, valor_total, id_cupom, updated_at)) else cast(id_pedido as varchar) end
    order by updated_at desc nulls last, origem desc nulls last) = 1"""
_SQL["dedup_latest"] = f"select origem, * exclude (origem) from ({_NEWEST}) as n"

_CUSTOMERS = """
  select id_cliente, trim(nome) as nome, lower(trim(email)) as email,
    regexp_replace(cpf, '[^0-9]', '', 'g') as cpf,
    regexp_replace(telefone, '[^0-9]', '', 'g') as telefone, data_nascimento, trim(genero) as genero,
    logradouro, cidade, upper(trim(estado)) as estado, cep, data_cadastro, updated_at
  from {clientes_brutos}"""
_CUSTOMER_RULES = {
    "email:pattern": r"regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')",
    "cpf:pattern": r"regexp_matches(cpf, '^\d[11]$')",
    "telefone:pattern": r"regexp_matches(telefone, '^\d[10,13]$')",
    "genero:domain": "genero in ('M', 'F', 'Outro')",
    "estado:pattern": "regexp_matches(estado, '^[A-Z][2]$')",
    "cep:pattern": r"regexp_matches(cep, '^\d[8]$')",
    "id_cliente:minimum": "id_cliente >= 1",
}
# counted repetitions; brackets above only keep the braces away from the entity placeholders
for _k, _v in (("[11]", "11"), ("[10,13]", "10,13"), ("[2]", "2"), ("[8]", "8")):
    _CUSTOMER_RULES = {n: r.replace(_k, "{{" + _v + "}}") for n, r in _CUSTOMER_RULES.items()}
_GOOD_CUSTOMER = " and ".join(f"({r})" for r in _CUSTOMER_RULES.values())

_SQL["quality_filter"] = f"select * from ({_CUSTOMERS}) as c where {_GOOD_CUSTOMER}"
_SQL["quality_report"] = "select * from (" + " union all ".join(
    f"select '{n}' as rule, count(*) filter (not ({r})) as broken, count(*) as checked"
    f" from ({_CUSTOMERS}) as c" for n, r in _CUSTOMER_RULES.items()
) + ") as r where broken > 0"

# the source-side contract sees the texts as they arrive, before any clean-up
_DOCUMENT_COLUMNS = {
    "clientes": "id_cliente nome email cpf telefone data_nascimento genero logradouro cidade estado cep"
    " data_cadastro updated_at",
    "categorias": "id_categoria nome_categoria descricao updated_at",
    "fornecedores": "id_fornecedor nome_fornecedor cnpj email telefone logradouro cidade estado cep updated_at",
    "produtos": "id_produto nome_produto descricao preco estoque id_categoria id_fornecedor marca peso_kg updated_at",
    "cupons": "id_cupom codigo desconto_percentual valor_minimo data_validade ativo updated_at",
    "pedidos": "id_pedido id_cliente data_pedido status valor_total id_cupom updated_at",
    "itens_pedido": "id_item id_pedido id_produto quantidade valor_unitario desconto_percentual subtotal updated_at",
    "pagamentos": "id_pagamento id_pedido forma_pagamento status_pagamento valor data_pagamento parcelas updated_at",
    "entregas": "id_entrega id_pedido status_entrega data_envio data_entrega_prevista data_entrega_real"
    " transportadora codigo_rastreio updated_at",
    "avaliacoes": "id_avaliacao id_pedido id_cliente id_produto nota comentario data_avaliacao updated_at",
}
_MAY_BE_ABSENT = (("pedidos", "id_cupom"), ("entregas", "data_entrega_real"))
_ONE_OF = {
    "genero": "'M', 'F', 'Outro'",
    "status": "'pendente', 'processando', 'enviado', 'entregue', 'cancelado'",
    "forma_pagamento": "'cartao_credito', 'cartao_debito', 'pix', 'boleto'",
    "status_pagamento": "'aprovado', 'pendente', 'recusado', 'estornado'",
    "status_entrega": "'pendente', 'em_transito', 'entregue', 'devolvido'",
    "transportadora": "'Correios', 'JadLog', 'Total Express', 'Loggi', 'Azul Cargo', 'Latam Cargo', 'DHL', 'FedEx'",
}
_LIMITS = {
    "nota": ("range", "nota not between 1 and 5"), "parcelas": ("range", "parcelas not between 1 and 12"),
    "estado": ("length", "length(estado) <> 2"),
}


def _document_rules(table: str):
    """(rule, condition under which it is broken); a null arrives as a JSON null, which is no absence."""
    for c in _DOCUMENT_COLUMNS[table].split():
        optional = (table, c) in _MAY_BE_ABSENT
        if not optional:
            yield f"{c}:required", "false"
        if c in _ONE_OF:
            yield f"{c}:domain", f"{c} not in ({_ONE_OF[c]})"
        else:
            yield f"{c}:type", "false" if optional else f"{c} is null"
        if c in _LIMITS:
            yield f"{c}:{_LIMITS[c][0]}", _LIMITS[c][1]


_WITH_DEFECTS = ("clientes", "fornecedores", "pedidos", "pagamentos", "entregas", "avaliacoes")
_SQL["schema_contract_report"] = " union all ".join(
    f"select '{t}' as tabela, '{rule}' as rule, count(*) filter ({broken}) as broken, count(*) as checked"
    f" from {{{t}{'_brutos' if t in _WITH_DEFECTS else ''}}}"
    for t in _DOCUMENT_COLUMNS for rule, broken in _document_rules(t)
)
_SQL["key_uniqueness"] = """
select id_pedido, count(*) as copies from {pedidos_brutos} where id_pedido is not null
group by id_pedido having count(*) > 1"""
_SQL["fk_required_semi"] = """
select * from {pedidos} where id_cliente in (select id_cliente from {clientes_parciais})"""
_SQL["fk_optional"] = """
select * from {pedidos}
where id_cupom is null or id_cupom in (select id_cupom from {cupons_parciais})"""
_SQL["fk_orphans"] = """
select * from {pedidos} where id_cliente not in (select id_cliente from {clientes_parciais})"""
_RANKED_CUSTOMERS = f"""
  select *, row_number() over (partition by cpf order by updated_at desc, id_cliente desc) as n
  from ({_SQL['quality_filter']}) as q"""
_SQL["unique_rule_kept"] = f"""
select id_cliente, cpf, updated_at from ({_RANKED_CUSTOMERS}) as r where n = 1"""
_SQL["silver_incremental"] = f"""
with todas as (
  {_CUSTOMERS} union all {_CUSTOMERS.replace('clientes_brutos', 'clientes_corrigidos')}),
novas as (select * from todas qualify row_number() over (partition by id_cliente order by updated_at desc) = 1)
select * from novas where {_GOOD_CUSTOMER}
qualify row_number() over (partition by cpf order by updated_at desc, id_cliente desc) = 1"""
_SQL["fk_late_parents"] = """
select *, concat_ws(',', case when id_cliente % 10 = 3 and id_cliente % 20 <> 3 then 'id_cliente' end,
  case when id_cupom % 10 = 3 and id_cupom % 20 <> 13 then 'id_cupom' end) as faltam
from {pedidos}"""
_SQL["unique_rule_rejected"] = """
select id_pagamento, id_pedido, updated_at, 'pagamento_duplicado_aprovado' as tipo_rejeicao
from {pagamentos} where status_pagamento = 'aprovado'
qualify row_number() over (partition by id_pedido order by updated_at desc, id_pagamento desc) > 1"""

_JUDGED_ORDERS = f"""
  select *, case
      when id_pedido is null or data_pedido is null or valor_total < 0 or status not in
        ('pendente', 'processando', 'enviado', 'entregue', 'cancelado') then 'field'
      when id_cliente not in (select id_cliente from {{clientes_parciais}})
        then 'id_cliente -> clientes.id_cliente'
      when id_cupom is not null and id_cupom not in (select id_cupom from {{cupons_parciais}})
        then 'id_cupom -> cupons.id_cupom'
      else 'valid' end as fate
  from ({_NEWEST}) as n"""
_SQL["silver_orders"] = f"""
select * exclude (origem, fate) from ({_JUDGED_ORDERS}) as j where fate = 'valid'"""

_CPF_RULE = "CPF deve ser unico entre clientes — mantido o registro com updated_at mais recente"
_CUSTOMER_FIELDS = ("id_cliente:minimum", "email:pattern", "cpf:pattern", "telefone:pattern",
                    "genero:domain", "estado:pattern", "cep:pattern")
_WHY_CUSTOMER = "concat_ws(',', " + ", ".join(
    f"case when not ({_CUSTOMER_RULES[n]}) then '{n}' end" for n in _CUSTOMER_FIELDS
) + ")"
_WHY_ORDER = """concat_ws(',',
    case when id_pedido is null then 'id_pedido:required' end,
    case when data_pedido is null then 'data_pedido:required' end,
    case when status = '' then 'status:required' end,
    case when status not in ('pendente', 'processando', 'enviado', 'entregue', 'cancelado')
      then 'status:domain' end,
    case when valor_total < 0 then 'valor_total:minimum' end)"""
_SQL["quality_log"] = f"""
select 'pedidos' as tabela, cast(id_pedido as varchar) as chave_primaria,
  case when fate = 'field' then 'campo_invalido' else 'referencia_inexistente' end
    as tipo_rejeicao, case when fate = 'field' then {_WHY_ORDER} else fate end as detalhe
from ({_JUDGED_ORDERS}) as j where fate <> 'valid'
union all
select 'clientes', cast(id_cliente as varchar), 'campo_invalido', {_WHY_CUSTOMER}
from ({_CUSTOMERS}) as c where not ({_GOOD_CUSTOMER})
union all
select 'clientes', cast(id_cliente as varchar), 'cpf_duplicado', '{_CPF_RULE}'
from ({_RANKED_CUSTOMERS}) as r where n > 1"""

_ACCOUNTS = f"""
  select 'pedidos' as "table", (select count(*) from {{pedidos_brutos}}) as records_read,
    count(*) as records_deduplicated, count(*) filter (fate = 'field') as field_rejected,
    0::bigint as business_rule_rejected,
    count(*) filter (fate not in ('field', 'valid')) as referential_rejected,
    count(*) filter (fate = 'valid') as records_valid
  from ({_JUDGED_ORDERS}) as j
  union all
  select 'clientes', (select count(*) from {{clientes_brutos}}), count(*),
    count(*) filter (not good), count(*) filter (good and n > 1), 0,
    count(*) filter (good and n = 1)
  from (select c.*, {_GOOD_CUSTOMER} as good, row_number() over (
      partition by cpf, {_GOOD_CUSTOMER} order by updated_at desc, id_cliente desc) as n
    from ({_CUSTOMERS}) as c) as d"""
_FULL_ACCOUNTS = f"""
  select *, records_deduplicated - records_valid as records_rejected,
    records_read - records_deduplicated as duplicates_removed from ({_ACCOUNTS}) as a"""
_SQL["quality_accounting"] = _FULL_ACCOUNTS
_SQL["run_manifest"] = "select " + ", ".join(
    f"sum({c})::bigint as {c}" for c in (
        "records_read", "duplicates_removed", "field_rejected", "business_rule_rejected",
        "referential_rejected", "records_rejected", "records_valid")
) + f" from ({_FULL_ACCOUNTS}) as f"

# --- merges and history -------------------------------------------------------------------------

_CONTENT = ("id_cliente", "data_pedido", "status", "valor_total", "id_cupom")
_DIFFERS = "(" + " or ".join(f"s.{c} is distinct from t.{c}" for c in _CONTENT) + ")"
_PAIRS = "{pedidos_antes} t full outer join {pedidos_lote} s on s.id_pedido = t.id_pedido"


def _actions(changed: str, only_old: str) -> str:
    return (
        f"case when t.id_pedido is null then 'inserted' when s.id_pedido is null then '{only_old}'"
        f" when {changed} then 'updated' else 'unchanged' end"
    )


_MERGED = _actions(
    f"s.updated_at > t.updated_at or (s.updated_at = t.updated_at and {_DIFFERS})", "kept")
_SYNCED = _actions(_DIFFERS, "deleted")


def _state(action: str) -> str:
    columns = ", ".join(
        f"case when {action} in ('inserted', 'updated') then s.{c} else t.{c} end as {c}"
        for c in ("id_pedido", *_CONTENT, "updated_at")
    )
    return f"select {columns}, {action} as acao from {_PAIRS}"


def _counts(action: str, names: tuple[str, ...], written: str) -> str:
    columns = ", ".join(f"count(*) filter (acao = '{n}') as {n}" for n in names)
    return (
        f"select {columns}, count(*) filter (acao in ({written})) as rows_written"
        f" from (select {action} as acao from {_PAIRS}) as x"
    )


_SQL["merge_upsert"] = _state(_MERGED)
_SQL["merge_metrics"] = _counts(
    _MERGED, ("inserted", "updated", "unchanged", "kept"), "'inserted', 'updated'")
_SQL["change_classify"] = (
    f"select coalesce(s.id_pedido, t.id_pedido) as id_pedido, {_MERGED} as acao from {_PAIRS}")
_SQL["full_sync"] = _state(_SYNCED)
_SQL["full_sync_metrics"] = _counts(
    _SYNCED, ("inserted", "updated", "unchanged", "deleted"), "'inserted', 'updated', 'deleted'")
_SQL["sync_deleted_keys"] = """
select id_pedido from {pedidos_antes} except select id_pedido from {pedidos_lote}"""


def _sk(key: str, since: str) -> str:
    return f"sha256(concat({key}, '||', strftime({since}, '%Y-%m-%d %H:%M:%S'), '.000'))"


_BEGIN, _END = "timestamp '1900-01-01 00:00:00'", "timestamp '9999-12-31 23:59:59'"
_AT = "timestamp '2002-01-01 00:00:00'"
_SCD_PAIRS = "{clientes} t full outer join {clientes_depois} s on s.id_cliente = t.id_cliente"
_SCD = """case when t.id_cliente is null then 'new' when s.id_cliente is null then 'missing'
  when s.cidade <> t.cidade then 'changed' else 'unchanged' end"""
_SQL["scd2_apply"] = f"""
with pares as (select t.id_cliente as old_key, t.nome as old_nome, t.cidade as old_cidade,
    s.id_cliente as new_key, s.nome as new_nome, s.cidade as new_cidade, {_SCD} as a
  from {_SCD_PAIRS})
select old_key as cliente_key, old_nome as nome, old_cidade as cidade,
  {_sk('old_key', _BEGIN)} as cliente_sk, {_BEGIN} as dw_valid_from,
  case when a = 'changed' then {_AT} else {_END} end as dw_valid_to,
  a <> 'changed' as dw_is_current, case when a = 'changed' then 'expired' else a end as acao
from pares where a <> 'new'
union all
select new_key, new_nome, new_cidade, case when a = 'new' then {_sk('new_key', _BEGIN)}
  else {_sk('new_key', _AT)} end, case when a = 'new' then {_BEGIN} else {_AT} end, {_END}, true, a
from pares where a in ('new', 'changed')"""
_SQL["scd2_second_change"] = f"select * exclude (acao) from ({_SQL['scd2_apply']}) as v"
_SQL["scd2_metrics"] = f"""
select count(*) filter (a = 'new') as inserted, count(*) filter (a = 'changed') as updated,
  count(*) filter (a = 'unchanged') as unchanged, 0::bigint as deleted,
  count(*) filter (a = 'changed') as versions_expired,
  count(*) filter (a in ('new', 'changed')) as versions_inserted,
  count(*) filter (a = 'new') + 2 * count(*) filter (a = 'changed') as rows_written
from (select {_SCD} as a from {_SCD_PAIRS}) as x"""

_PAST = "timestamp '1998-06-15 00:00:00'"
_SQL["scd2_backdated"] = f"""
with estado as ({_SQL["scd2_apply"]}),
mudancas as (
  select id_cliente as k, nome, concat(cidade, ' 0') as cidade, {_PAST} as desde from {{clientes}} where id_cliente % 4 = 0
  union all select id_cliente, nome, cidade, timestamp '1997-01-01 00:00:00' from {{clientes}} where id_cliente % 9 = 0
  union all select id_cliente, nome, concat(cidade, ' 3'), {_AT} from {{clientes}} where id_cliente % 6 = 0 and id_cliente % 4 <> 0
  union all select id_cliente + 2000000000, nome, cidade, {_BEGIN} from {{clientes}} where id_cliente % 50 = 1),
inicios as (
  select cliente_key as k, nome, cidade, dw_valid_from as desde, dw_valid_to as ate, cliente_sk as sk, 0 as tipo from estado
  union all select k, nome, cidade, desde, null, null, 1 from mudancas),
um as (
  select k, desde, arg_max(nome, tipo) as nome, arg_max(cidade, tipo) as cidade, max(sk) as sk, max(ate) as ate,
    max(case when tipo = 0 then cidade end) as era, bool_or(tipo = 0) as havia
  from inicios group by k, desde),
novos as (select * from um qualify havia or coalesce(cidade <> lag(cidade) over (partition by k order by desde), true)),
fins as (select *, coalesce(lead(desde) over (partition by k order by desde), {_END}) as fim from novos)
select k as cliente_key, nome, cidade, coalesce(sk, {_sk('k', 'desde')}) as cliente_sk, desde as dw_valid_from,
  fim as dw_valid_to, fim = {_END} as dw_is_current,
  case when k not in (select k from mudancas) then 'untouched' when havia and era <> cidade then 'replaced'
    when havia and ate <> fim then 'expired' when havia then 'kept' when desde = {_BEGIN} then 'new' else 'changed' end as acao
from fins"""

_MOVED = "timestamp '1998-06-15 00:00:00'"


def _versions(entity: str, key: str) -> str:
    return f"""(
      select {key} as k, {_sk(key, _BEGIN)} as sk, {_BEGIN} as since,
        case when {key} % 3 = 0 then {_MOVED} else {_END} end as until from {{{entity}}}
      union all
      select {key}, {_sk(key, _MOVED)}, {_MOVED}, {_END} from {{{entity}}} where {key} % 3 = 0)"""


def _as_of(alias: str, versions: str, key: str, event: str) -> str:
    return (
        f"left join {versions} as {alias} on {alias}.k = {key}"
        f" and cast({event} as timestamp) >= {alias}.since"
        f" and cast({event} as timestamp) < {alias}.until"
    )


_SQL["pit_join"] = f"""
select g.pagamento_key, g.cliente_key, g.data_pagamento, c.sk as cliente_sk
from ({_SQL['fact_payments']}) as g
{_as_of('c', _versions('clientes', 'id_cliente'), 'g.cliente_key', 'g.data_pagamento')}"""
_SQL["pit_join_merge"] = _SQL["pit_join"]
_SQL["gold_sales"] = f"""
select v.venda_key, v.data_pedido, v.cliente_key, v.produto_key, v.cupom_key, v.receita_liquida,
  c.sk as cliente_sk, p.sk as produto_sk, u.sk as cupom_sk
from {_SALES}
{_as_of('c', _versions('clientes', 'id_cliente'), 'v.cliente_key', 'v.data_pedido')}
{_as_of('p', _versions('produtos', 'id_produto'), 'v.produto_key', 'v.data_pedido')}
{_as_of('u', _versions('cupons', 'id_cupom'), 'v.cupom_key', 'v.data_pedido')}"""

# --- extraction and raw ingestion ---------------------------------------------------------------

_SINCE = "timestamp '2000-01-14 12:00:00'"
_SQL["incremental_extract"] = f"select * from {{pedidos}} where updated_at >= {_SINCE}"
_SQL["checkpoint_advance"] = " union all ".join(
    f"select '{n}' as collection, count(*) as document_count,"
    f" coalesce(max(updated_at), timestamp '2000-01-15 12:00:00') as checkpoint"
    f" from {{{n}}} where updated_at >= {_SINCE}"
    for n in ("clientes", "categorias", "fornecedores", "produtos", "cupons", "pedidos",
              "itens_pedido", "pagamentos", "entregas", "avaliacoes")
)
_SQL["path_lineage"] = """
select id_pedido, data_pedido as dia_extracao, concat('r', id_pedido % 7) as execucao
from {pedidos}"""
_PATH = """concat('s3a://lake/landing/shop/pedidos/extraction_date=', data_pedido, '/run_id=r',
  id_pedido % 7, '/part-00000.json')"""
_SQL["ledger_anti_join"] = f"""
select id_pedido, {_PATH} as arquivo from {{pedidos}} where id_pedido % 7 % 2 = 0"""
_SQL["ingest_counts"] = f"""
select count(*) as rows_written, count(distinct {_PATH}) as source_files from {{pedidos}}"""

_SQL["bronze_scan"] = _SQL["ext_json_encode"]
_SQL["bronze_ingest"] = """
select *, date '2002-01-01' as dia_extracao,
  case when id_pedido % 3 <> 0 then 'r1' else 'r2' end as execucao,
  case when id_pedido % 3 <> 0 then 'c1' else 'c2' end as carga
from {pedidos}"""
_SQL["stream_ingest"] = _SQL["bronze_ingest"]
_SQL["ledger_incremental"] = "select * from {pedidos} where id_pedido % 5 > 1"
_SQL["stream_merge"] = f"select * exclude (acao) from ({_SQL['merge_upsert']}) as m"
_SQL["stream_dedup"] = "select * from {pedidos}"
_SQL["csv_typed_scan"] = """
select id_pedido, id_cliente, cast(data_pedido as timestamp) as data_pedido, status,
  cast(valor_total as double) as valor_total, id_cupom, updated_at from {pedidos}"""


def _draw(name: str, low: int, high: int) -> str:
    return f"(hash60(concat_ws('|', '42', '{name}', cast(id as varchar))) % {high - low + 1} + {low})"


def _dice(name: str, values: dict[str, int]) -> str:
    cases = " ".join(f"when {_draw(name, 0, 99)} < {limit} then '{v}'" for v, limit in values.items())
    return f"case {cases} end"


_DAY = f"date '2023-01-01' + cast({_draw('order_day', 0, 1257)} as int)"
_SQL["synthetic_orders"] = f"""
select id as id_pedido, {_draw('customer', 1, 1000)} as id_cliente, {_DAY} as data_pedido,
  {_dice('status', {'pendente': 5, 'processando': 15, 'enviado': 30, 'entregue': 85,
                    'cancelado': 100})} as status,
  cast(cast({_draw('total', 2000, 300000)} as decimal(18,2)) / 100 as decimal(18,2)) as valor_total,
  case when {_draw('has_coupon', 0, 99)} < 25 then {_draw('coupon', 1, 50)} end as id_cupom,
  cast({_DAY} + cast({_draw('updated_at', 0, 1 << 40)}
    % (greatest(date '2026-06-11' - ({_DAY}), 1) + 1) as int) as timestamp) as updated_at
from (select o_orderkey + 1 as id from {{orders}}) as o"""

_PAID = f"date '2023-01-01' + cast({_draw('paid', 0, 1257)} as int)"
_METHOD = _dice("method", {"cartao_credito": 45, "cartao_debito": 65, "pix": 90, "boleto": 100})
_SQL["synthetic_payments"] = f"""
select id as id_pagamento, {_draw('order', 1, 1000)} as id_pedido, {_METHOD} as forma_pagamento,
  {_dice('status', {'aprovado': 80, 'pendente': 90, 'recusado': 97, 'estornado': 100})}
    as status_pagamento,
  cast(cast({_draw('value', 2000, 300000)} as decimal(18,2)) / 100 as decimal(18,2)) as valor,
  {_PAID} as data_pagamento,
  case when {_METHOD} = 'cartao_credito' then {_draw('months', 1, 12)} else 1 end as parcelas,
  cast({_PAID} + cast({_draw('updated_at', 0, 1 << 40)}
    % (greatest(date '2026-06-11' - ({_PAID}), 1) + 1) as int) as timestamp) as updated_at
from (select o_orderkey + 1 as id from {{orders}}) as o"""


def _changed(start: str) -> str:
    return (f"cast({start} + cast({_draw('updated_at', 0, 1 << 40)}"
            f" % (greatest(date '2026-06-11' - ({start}), 1) + 1) as int) as timestamp) as updated_at")


def _day(name: str) -> str:
    return f"date '2023-01-01' + cast({_draw(name, 0, 1257)} as int)"


def _cents(amount: str) -> str:
    return f"cast(cast({amount} as decimal(18,2)) / 100 as decimal(18,2))"


def _choice(name: str, values) -> str:
    texts = ", ".join(f"'{v}'" for v in values)
    return f"[{texts}][cast({_draw(name, 1, len(values))} as int)]"


_IDS = "(select o_orderkey + 1 as id from {orders}) as o"
_LEFT = f"(100 - {_draw('discount', 0, 30)})"
_SQL["synthetic_items"] = f"""
select id as id_item, {_draw('order', 1, 1000)} as id_pedido, {_draw('product', 1, 200)} as id_produto,
  {_draw('quantity', 1, 4)} as quantidade, {_cents(_draw('price', 990, 28990))} as valor_unitario,
  cast({_draw('discount', 0, 30)} as decimal(5,2)) as desconto_percentual,
  {_cents(f"(({_draw('quantity', 1, 4)} * {_draw('price', 990, 28990)} * {_LEFT} + 50) // 100)")} as subtotal,
  cast({_day('updated_at')} as timestamp) as updated_at
from {_IDS}"""
_DUE = f"({_day('sent')}) + cast({_draw('lead', 3, 20)} as int)"
_SENT_STATUS = _dice("status", {"pendente": 8, "em_transito": 23, "entregue": 95, "devolvido": 100})
_SQL["synthetic_deliveries"] = f"""
select id as id_entrega, {_draw('order', 1, 1000)} as id_pedido, {_SENT_STATUS} as status_entrega,
  {_day('sent')} as data_envio, {_DUE} as data_entrega_prevista,
  case {_SENT_STATUS} when 'entregue' then {_DUE} + cast({_draw('delay', -2, 5)} as int)
    when 'devolvido' then {_DUE} + cast({_draw('return', 5, 15)} as int) end as data_entrega_real,
  {_choice('carrier', ('Correios', 'JadLog', 'Total Express', 'Loggi', 'Azul Cargo', 'Latam Cargo', 'DHL', 'FedEx'))}
    as transportadora,
  concat(chr(cast({_draw('letter0', 65, 90)} as int)), chr(cast({_draw('letter1', 65, 90)} as int)),
    lpad(cast({_draw('tracking', 0, 999999999)} as varchar), 9, '0'), 'BR') as codigo_rastreio,
  {_changed(_day('sent'))}
from {_IDS}"""
_RATING = _dice("rating", {"1": 5, "2": 13, "3": 25, "4": 55, "5": 100})
_SQL["synthetic_reviews"] = f"""
select id as id_avaliacao, {_draw('order', 1, 1000)} as id_pedido, {_draw('customer', 1, 1000)} as id_cliente,
  {_draw('product', 1, 200)} as id_produto, cast({_RATING} as bigint) as nota,
  case when cast({_RATING} as bigint) >= 4 then {_choice('good', GOOD)}
    when cast({_RATING} as bigint) = 3 then {_choice('neutral', NEUTRAL)} else {_choice('bad', BAD)} end as comentario,
  {_day('reviewed')} as data_avaliacao, {_changed(_day('reviewed'))}
from {_IDS}"""
_SQL["append_evolution"] = """
select id_pedido, id_cliente, data_pedido, status, valor_total, case when id_pedido % 2 = 1 then id_cupom end as id_cupom,
  updated_at, year(data_pedido) as ano from {pedidos}"""
_SQL["star_export"] = f"""
select id_item, id_pedido, cast(data_pedido as timestamp) as data_pedido, ano_mes, cliente, produto, cupom,
  forma_pagamento, status_entrega, quantidade, cast(receita_liquida as double) as receita_liquida
from ({_FLAT}) as f"""
_COUNTED = " union all ".join(
    f"select '{t}' as tabela, count(*) as linhas from {{{t}}}" for t in _DOCUMENT_COLUMNS)
_SQL["manifest_document"] = f"""
select dag_id, 'r1' as run_id, '2002-01-01T06:00:00Z' as logical_date, layer, tabela, linhas,
  (sum(linhas) over (partition by layer))::bigint as total
from ({_COUNTED}) as c,
  (values ('source_to_landing', 'landing'), ('landing_to_bronze', 'bronze')) as j(dag_id, layer)"""
_SQL["layered_payments"] = f"""
select g.*, {_sk('g.cliente_key', _BEGIN)} as cliente_sk from ({_SQL['fact_payments']}) as g
qualify g.status_pagamento <> 'aprovado' or row_number() over (
  partition by g.id_pedido, g.status_pagamento
  order by g.data_pagamento desc, g.id_pagamento desc) = 1"""


# --- the second cycle -----------------------------------------------------------------------------


def _final(sql: str) -> str:
    """The same query over what is known after the second batch."""
    for entity in ("clientes", "categorias", "fornecedores", "produtos", "cupons", "pedidos", "itens_pedido",
                   "pagamentos", "entregas", "avaliacoes"):
        sql = sql.replace(f"{{{entity}}}", f"{{{entity}_fim}}")
    return sql


def _loaded_twice(sql: str, key: str, content: str) -> str:
    """Versions after two loads: (k, c, sk, since, until)."""
    before, after = (f"(select {key} as k, {content} as c from ({q}) as x)" for q in (sql, _final(sql)))
    return f"""(
      select a.k, b.c, {_sk('a.k', _BEGIN)} as sk, {_BEGIN} as since,
        case when b.c <> a.c then {_MOVED} else {_END} end as until
      from {after} as a join {before} as b using (k)
      union all select a.k, a.c, {_sk('a.k', _MOVED)}, {_MOVED}, {_END}
      from {after} as a join {before} as b using (k) where b.c <> a.c
      union all select a.k, a.c, {_sk('a.k', _BEGIN)}, {_BEGIN}, {_END}
      from {after} as a anti join {before} as b using (k))"""


_TWICE = {
    "dim_cliente": _loaded_twice(_SQL["dim_customer"], "cliente_key", "cidade"),
    "dim_produto": _loaded_twice(
        _SQL["dim_product"], "produto_key", "concat_ws('|', preco, descricao_categoria, estado_fornecedor)"),
    "dim_cupom": _loaded_twice(_SQL["dim_coupon"], "cupom_key", "cast(ativo as varchar)"),
}


def _fact_twice(model: str, sql: str, key: str, event: str, content: str, *dims: str) -> str:
    names = {"dim_cliente": "cliente_key", "dim_produto": "produto_key", "dim_cupom": "cupom_key"}
    joins = " ".join(_as_of(f"d{i}", _TWICE[d], f"v.{names[d]}", f"v.{event}") for i, d in enumerate(dims))
    keys = ", ".join(f"coalesce(d{i}.sk, '-')" for i in range(len(dims)))
    return (f"select '{model}' as modelo, v.{key} as chave, concat_ws('|', {content}) as conteudo,"
            f" concat_ws('|', {keys}) as surrogados, null::boolean as atual from ({_final(sql)}) as v {joins}")


_PAID_ONCE = f"""select * from ({_SQL['fact_payments']}) as g
qualify g.status_pagamento <> 'aprovado' or row_number() over (
  partition by g.id_pedido, g.status_pagamento order by g.data_pagamento desc, g.id_pagamento desc) = 1"""
_SQL["layered_second_run"] = " union all ".join([
    f"select 'dim_tempo' as modelo, data_key as chave, ano_mes as conteudo, '' as surrogados, null::boolean as atual"
    f" from ({_final(_SQL['dim_calendar'])}) as t",
    *(f"select '{m}', k, c, sk, until = {_END} from {v}" for m, v in _TWICE.items()),
    _fact_twice("fato_vendas", _SQL["fact_sales"], "venda_key", "data_pedido", "ano, quantidade, status_pedido, data_pedido",
                "dim_cliente", "dim_produto", "dim_cupom"),
    _fact_twice("fato_pagamentos", _PAID_ONCE, "pagamento_key", "data_pagamento", "ano, valor, status_pagamento", "dim_cliente"),
    _fact_twice("fato_entregas", _SQL["fact_deliveries"], "entrega_key", "data_envio", "ano, prazo_previsto_dias", "dim_cliente"),
    _fact_twice("fato_avaliacoes", _SQL["fact_reviews"], "avaliacao_key", "data_avaliacao", "ano, nota", "dim_cliente", "dim_produto"),
])

ORACLES: dict[str, str] = {name: with_shop(sql) for name, sql in _SQL.items()}
