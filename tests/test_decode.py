import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from camadas.entities import ENTITIES
from camadas.functions.extjson import decode, encode
from camadas.functions.keys import day_key
from camadas.operators import quality
from workload.queries import QUERIES
from workload.shop import Shop

DOCUMENT = (
    '{"_id":{"$oid":"5f0c3a9b7d1e4a6688c2d4e7"},"id_pedido":{"$numberInt":"31"},'
    '"id_cliente":{"$numberLong":"4408"},"data_pedido":{"$date":{"$numberLong":"1722374400000"}},'
    '"status":"  ENTREGUE ","valor_total":{"$numberDouble":"87.25"},"id_cupom":null,'
    '"updated_at":{"$date":{"$numberLong":"1722374400999"}}}'
)


def one(spark, text, table="pedidos"):
    raw = spark.createDataFrame([(text,)], "raw_document string")
    return decode(raw, ENTITIES[table]).first()


def test_document_is_typed_and_normalised(spark):
    row = one(spark, DOCUMENT)
    assert row.id_pedido == 31 and row.id_cliente == 4408 and row.id_cupom is None
    assert row.data_pedido == dt.date(2024, 7, 30) and row.valor_total == Decimal("87.25")
    assert row.status == "entregue"
    assert row.updated_at == dt.datetime(2024, 7, 30, 21, 20)  # sub-second part dropped


def test_what_does_not_parse_is_null(spark):
    assert all(v is None for k, v in one(spark, "no json").asDict().items() if k != "raw_document")
    assert one(spark, DOCUMENT.replace('{"$numberInt":"31"}', "7")).id_pedido is None
    assert one(spark, DOCUMENT.replace('{"$numberInt":"31"}', "{}")).id_pedido is None
    assert one(spark, DOCUMENT.replace('"31"', '"12.7"')).id_pedido == 12
    assert one(spark, DOCUMENT.replace('"31"', '"x"')).id_pedido is None
    iso = DOCUMENT.replace('{"$numberLong":"1722374400000"}', '"2024-07-30T21:20:00Z"')
    assert one(spark, iso).data_pedido is None
    far = DOCUMENT.replace("1722374400000", "9223372036854775807")
    assert one(spark, far).data_pedido is None
    assert one(spark, DOCUMENT.replace("1722374400000", "-1500")).data_pedido == dt.date(1969, 12, 31)


def test_instants_before_year_1_and_after_9999_are_kept(spark):
    days = {"-86399999000000": -1000000, "253402300800000": 2932897}  # unix days
    for millis, day in days.items():
        raw = spark.createDataFrame([(DOCUMENT.replace("1722374400000", millis),)], "raw_document string")
        found = decode(raw, ENTITIES["pedidos"])
        assert found.select(F.unix_date("data_pedido")).first()[0] == day
        key = found.select(day_key(F.col("data_pedido")), F.expr("year(data_pedido)")).first()
        assert abs(key[0]) // 10000 in (abs(key[1]), abs(key[1]) - 1) and (key[0] < 0) == (day < 0)


def test_digits_and_case(spark):
    text = (
        '{"cpf":" 123.456.789-00 ","telefone":"+55 11 99999-0001","estado":" sp ",'
        '"email":" A@B.Com ","nome":"\\tX "}'
    )
    row = one(spark, text, "clientes")
    assert (row.cpf, row.telefone, row.estado) == ("12345678900", "5511999990001", "SP")
    assert (row.email, row.nome) == ("a@b.com", "\tX")


def test_encode_decode_is_the_identity(spark):
    raw = spark.createDataFrame([(DOCUMENT,)], "raw_document string")
    once = decode(raw, ENTITIES["pedidos"]).drop("raw_document")
    again = decode(encode(once, ENTITIES["pedidos"]), ENTITIES["pedidos"]).drop("raw_document")
    assert once.collect() == again.collect()


def test_encode_tells_int_from_long(spark):
    df = spark.sql(
        "select 1 as id_categoria, 'a' as nome_categoria, cast(null as string) as descricao,"
        " timestamp '1970-01-01 00:00:01' as updated_at"
    )
    assert encode(df, ENTITIES["categorias"]).first()[0] == (
        '{"id_categoria":{"$numberInt":"1"},"nome_categoria":"a","descricao":null,'
        '"updated_at":{"$date":{"$numberLong":"1000"}}}'
    )


def test_document_contract(spark):
    bad = DOCUMENT.replace('"  ENTREGUE "', '"x"').replace('{"$numberLong":"4408"}', '"4408"')
    missing = DOCUMENT.replace('"status":"  ENTREGUE ",', "")
    raw = spark.createDataFrame([(DOCUMENT.replace("  ENTREGUE ", "entregue"),), (bad,), (missing,)],
                                "raw_document string")
    report = quality.document_report(raw, ENTITIES["pedidos"]).filter("broken > 0").collect()
    assert {(r.rule, r.broken) for r in report} == {
        ("id_cliente:type", 1), ("status:domain", 1), ("status:required", 1),
    }


def test_plain_documents_are_not_parsed_and_break_no_rule(spark):
    """Every spelling is judged as by parsing it; documents that need no parsing are recognised by their text."""
    plain = DOCUMENT.replace("  ENTREGUE ", "entregue")
    payment = (
        '{"id_pagamento":{"$numberInt":"1"},"id_pedido":{"$numberLong":"1"},"forma_pagamento":"pix",'
        '"status_pagamento":"aprovado","valor":{"$numberDouble":"1.50"},"data_pagamento":{"$date":{"$numberLong":"0"}},'
        '"parcelas":{"$numberLong":"12"},"updated_at":{"$date":{"$numberLong":"0"}}}'
    )
    spelled = [
        (lambda d: d), (lambda d: d + "\n"), (lambda d: " " + d), (lambda d: d + d), (lambda d: d[:-1]), (lambda d: f"[{d}]"),
        (lambda d: d[:-1] + ',"more":1}'), (lambda d: d[:-1] + "," + d[1:]), (lambda d: d.replace(":", " : ")),
        (lambda d: d.replace('"12"', '"13"')), (lambda d: d.replace('"12"', '"12.0"')), (lambda d: d.replace('"12"', '"x"')),
        (lambda d: d.replace('"pix"', '"p\\u0069x"')), (lambda d: d.replace('"pix"', "null")), (lambda d: d.replace('"1.50"', "1.50")),
        (lambda d: d.replace("$numberLong", "$numberDouble")), (lambda d: d.replace('"0"', '"\x01"')), (lambda d: d.replace('"0"', '"\\q"')),
        (lambda d: d.replace('"0"', '"' + "9" * 10_001 + '"')), (lambda d: None), (lambda d: ""), (lambda d: "null"),
    ]
    for name, document in (("pedidos", plain), ("pagamentos", payment)):
        entity = ENTITIES[name]
        raw = spark.createDataFrame([(i, change(document)) for i, change in enumerate(spelled)], "i int, raw_document string")
        parsed = raw.select(F.try_parse_json("raw_document").alias("_doc"))
        expected = quality.violation_counts(parsed, quality.document_checks(entity, F.col("_doc")))
        assert quality.document_report(raw, entity).collect() == expected.collect()
        known = raw.filter(F.col("raw_document").rlike(quality.plain_document(entity)))
        assert known.filter("i = 0").count() == 1
        clean = quality.violation_counts(
            known.select(F.try_parse_json("raw_document").alias("_doc")), quality.document_checks(entity, F.col("_doc")))
        assert clean.filter("broken > 0").count() == 0


def test_plain_documents_of_every_contract_are_recognised(spark):
    """Lengths count characters; a null is plain only where the contract lets a field be null."""
    shop = Shop(spark, "/root/testdata/sf0.001")
    for name, entity in ENTITIES.items():
        raw = encode(shop[name], entity)
        assert raw.filter(~F.col("raw_document").rlike(quality.plain_document(entity))).count() == 0, name
    supplier = encode(shop["fornecedores"].limit(1), ENTITIES["fornecedores"]).first()[0]
    state = supplier[supplier.index('"estado":"') + 10:][:2]
    texts = [supplier.replace(f'"estado":"{state}"', f'"estado":{s}') for s in ('"\U0001F600\u00e9"', '"ABC"', '"A"', "null")]
    raw = spark.createDataFrame([(t,) for t in texts], "raw_document string")
    assert [r[0] for r in raw.select(F.col("raw_document").rlike(quality.plain_document(ENTITIES["fornecedores"]))).collect()] == [
        True, False, False, False]
    broken = {r.rule: r.broken for r in quality.document_report(raw, ENTITIES["fornecedores"]).collect() if r.broken}
    assert broken == {"estado:length": 2, "estado:type": 1}


def test_contract_report_writes_no_documents(spark):
    """Documents are read once, by the report; nothing is staged for it."""
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    report = QUERIES["schema_contract_report"](spark, "/root/testdata/sf0.001")
    assert report.filter("checked = 0").count() == 0
    assert set(os.listdir(shared)) == before
