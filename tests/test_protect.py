"""Masking and encryption."""

from pyspark.sql import functions as F

from vaultline.functions.protect import decrypt_value
from vaultline.metadata import sheet
from vaultline.operators import protect


def test_mask_modes(spark):
    df = spark.createDataFrame([("Ab-12c",), (None,), ("abc",)], "v string")
    assert [r[0] for r in protect.mask_columns(df, ["v"], "mask").collect()] == ["Xx-nnx", None, "xxx"]
    assert [r[0] for r in protect.mask_columns(df, ["v"], "last4").collect()] == ["**-12c", None, "***"]
    h = protect.mask_columns(df, ["v"], "hash").first()[0]
    assert len(h) == 64


def test_encrypt_round_trip_and_flags(spark):
    df = spark.createDataFrame([(1, "alice", "x"), (2, None, "y")], "id int, name string, other string")
    key = F.lit("0123456789abcdef")
    enc = protect.encrypt_columns(df, ["name"], key)
    assert enc.first()["name"] != "alice"
    back = enc.select(decrypt_value("name", key).alias("n")).collect()
    assert [r[0] for r in back] == ["alice", None]
    prot = sheet(spark, "protection", [dict(table_name="t", column_name="name", pii=True, mask=False, encrypt=True),
                                       dict(table_name="t", column_name="other", pii=True, mask=None, encrypt=None)])
    assert protect.flagged(prot, "t") == {"mask": ["other"], "encrypt": ["name"]}
    out = protect.protect(df, prot, "t", key)
    assert out.first()["other"] == "x"
