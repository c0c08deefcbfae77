import pytest

from camadas.contracts import select_collections, select_entities, select_models
from camadas.entities import ENTITIES, MODELS


def test_everything_is_selected_by_default_in_dependency_order():
    names = select_entities(None, ENTITIES)
    assert names == tuple(ENTITIES) and len(names) == 10
    for name in names:
        for ref in ENTITIES[name].references:
            assert names.index(ref.parent) < names.index(name)


def test_selection_restores_dependency_order():
    assert select_entities("produtos, fornecedores ,categorias", ENTITIES) == (
        "categorias", "fornecedores", "produtos",
    )
    assert select_models("fato_vendas,dim_cliente", MODELS) == ("dim_cliente", "fato_vendas")
    assert select_collections("pedidos,clientes", ENTITIES) == ("pedidos", "clientes")


@pytest.mark.parametrize("text", [" , ", "pedidos,pedidos", "nada", "pedidos"])
def test_bad_table_selections_are_refused(text):
    with pytest.raises(ValueError):
        select_entities(text, ENTITIES)


@pytest.mark.parametrize("text", [",", "dim_tempo,dim_tempo", "dim_nada"])
def test_bad_model_selections_are_refused(text):
    with pytest.raises(ValueError):
        select_models(text, MODELS)


def test_optional_fields_are_the_two_known_ones():
    optional = {(e.name, f.name) for e in ENTITIES.values() for f in e.fields if not f.required}
    assert optional == {("pedidos", "id_cupom"), ("entregas", "data_entrega_real")}


def test_models_have_keys_partitions_and_links():
    assert [m.kind for m in MODELS.values()] == ["dimension"] * 4 + ["fact"] * 4
    for m in MODELS.values():
        assert m.partition == (("ano",) if m.kind == "fact" else ())
        assert (m.natural_key is not None) == (m.history == "type2")
        for link in m.links:
            assert MODELS[link.dimension].history == "type2"
