import pytest

from fleetlake import registry


def test_tables_and_schemas():
    assert len(registry.TABLES) == 14
    for name, table in registry.TABLES.items():
        assert table.primary_key and len(table.columns) >= 5
        typed, raw = registry.typed_schema(name), registry.raw_schema(name)
        assert typed.names == raw.names == table.column_names
        assert {f.dataType.simpleString() for f in raw} == {"string"}
        assert set(table.primary_key) <= set(table.column_names)


def test_rules_point_at_columns():
    assert sum(map(len, registry.RULES.values())) == 57
    for name, rules in registry.RULES.items():
        assert len({r.id for r in rules}) == len(rules)
        for rule in rules:
            assert rule.kind in ("not_null", "enum", "range", "sql_expression")
            assert rule.severity == "ERROR"
            if rule.kind != "sql_expression":
                assert rule.column in registry.table(name).column_names


def test_foreign_keys_and_relationships_have_targets():
    for table in registry.TABLES.values():
        for fk in table.foreign_keys:
            assert fk.column in table.column_names
            assert fk.parent_column in registry.table(fk.parent_table).column_names
    for link in registry.RELATIONSHIPS:
        assert link.dim_key in [c.name for c in registry.GOLD[link.dim]]
        assert link.fact_key in [c.name for c in registry.GOLD[link.fact]]


def test_unknown_names():
    with pytest.raises(KeyError):
        registry.table("planes")
    with pytest.raises(KeyError):
        registry.relationship("fact_maintenance", "dim_route")
    assert registry.spark_type("geography").simpleString() == "string"
    assert registry.relationship("fact_trips", "dim_date", "load_date").active is False
