from letrado.sources import io


def test_namespaces_and_warehouse_table(spark, tmp_root):
    io.create_namespaces(spark, ["letrado_gold_test"])
    assert "letrado_gold_test" in [d.name for d in spark.catalog.listDatabases()]
    df = spark.createDataFrame([(2023, 1.0), (2024, 2.0)], "ano int, v double")
    io.save_table(df, "letrado_gold_test.painel", partition=["ano"])
    io.save_table(df.where("ano = 2024"), "letrado_gold_test.painel", partition=["ano"])  # truncating load
    assert spark.table("letrado_gold_test.painel").count() == 1


def test_layer_write_is_idempotent_per_date(spark, tmp_root):
    df = spark.createDataFrame([("1", 2023)], "id_municipio string, ano int")
    for _ in range(2):
        io.write_layer(df, tmp_root, "silver", "ufs", "2024-01-31")
    io.write_layer(df, tmp_root, "silver", "ufs", "2024-02-01")
    assert io.read_layer(spark, tmp_root, "silver", "ufs", "2024-01-31").count() == 1
    assert io.read_layer(spark, tmp_root, "silver", "ufs").count() == 2


def test_events_fall_back_to_all_days(spark, tmp_root):
    msgs = spark.createDataFrame([('{"event_id": "1"}',)], "value string")
    for _ in range(2):
        io.write_events(msgs, tmp_root, "2024-01-31")
    assert io.read_events(spark, tmp_root, "2024-01-31").count() == 1
    assert io.read_events(spark, tmp_root, "1999-01-01").count() == 1
