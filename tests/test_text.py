from pyspark.sql import functions as F

from tamarack.functions import payload, text


def column(spark, schema, rows, expression):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_rsid(spark):
    values = ["12", "12.0", "-1", "nan", None, "abc", ""]
    assert column(spark, "v string", [(v,) for v in values], text.rsid(F.col("v"))) == ["rs12", "rs12", None, None, None, None, None]


def test_chromosome_names(spark):
    values = ["7", "chr7", " X ", "MT", "m", "chrM", None]
    assert column(spark, "v string", [(v,) for v in values], text.chrom_name(F.col("v"))) == [
        "chr7", "chr7", "chrX", "chrM", "chrM", "chrM", None]
    assert column(spark, "v string", [("chr1_chrUn",)], text.without_chr(F.col("v"))) == ["1_Un"]


def test_region_key_and_hgvs(spark):
    rows = [
        ("chr7", "100.9", "rs1", "A", "G"), ("7", "100", None, "AT", "A"), ("7", "x", "rs1", "A", "G"), ("7", "1", "rs1", "", "G"),
        ("7", "1", "rs1", None, "G"), ("7", "1", "rs1", "nan", "G"),
    ]
    schema = "c string, s string, i string, r string, a string"
    c = [F.col(x) for x in "csira"]
    assert column(spark, schema, rows, text.region_key(*c)) == ["7 100 rs1 A G . . .", "7 100 . AT A . . .", None, None, None, None]
    assert column(spark, schema, rows, text.hgvs(c[0], c[1], c[3], c[4])) == ["chr7:g.100A>G", "chr7:g.100AT>A", None, None, None, None]
    assert column(spark, schema, rows, text.is_snv(c[3], c[4])) == [True, False, True, False, False, False]


def test_display(spark):
    assert column(spark, "v string", [("a" * 60,), ("a" * 61,)], text.short_name(F.col("v"))) == ["a" * 60, "a" * 60 + "..."]
    assert column(spark, "v double", [(0.8712,)], text.one_decimal_percent(F.col("v"))) == ["87.1%"]
    assert column(spark, "v double", [(0.879,)], text.whole_percent(F.col("v"))) == [87]
    names = [("num__gerp_score",), ("cat__most_severe_consequence_stop_gained",)]
    assert column(spark, "v string", names, text.plain_feature(F.col("v"))) == ["gerp_score", "stop_gained"]


def test_null_tokens_and_ordinals(spark):
    values = [("NA",), ("na",), ("",), ("x",), ("<NA>",)]
    assert column(spark, "v string", values, text.null_tokens_to_null(F.col("v"))) == [None, "na", None, "x", None]
    assert column(spark, "v string", [("HIGH",), ("odd",), (None,)], text.ordinal(F.col("v"), {"LOW": 1, "HIGH": 3})) == [3, None, None]


def annotation(spark, json):
    rows = spark.createDataFrame([(json,)], "j string").select(F.from_json("j", payload.ANNOTATION_SCHEMA).alias("p"))
    return rows.select(
        payload.first_impact(F.col("p.transcript_consequences")), payload.first_frequency(F.col("p.colocated_variants"))
    ).first()


def test_annotation_fields(spark):
    assert tuple(annotation(spark, '{"input": "a"}')) == (None, None)
    assert tuple(annotation(spark, '{"transcript_consequences": [], "colocated_variants": []}')) == (None, None)
    both = '{"transcript_consequences": [{"impact": "LOW"}, {"impact": "HIGH"}], "colocated_variants": [{"id": "x"}, {"frequencies": {"A": {"af": 0.9}, "G": {"gnomadg": 0.3, "gnomade": 0.2}}}, {"frequencies": {"T": {"gnomade": 0.1}}}]}'
    assert tuple(annotation(spark, both)) == ("LOW", 0.2)
    assert tuple(annotation(spark, '{"colocated_variants": [{"frequencies": {"A": {"gnomadg": 0.3}, "G": {"gnomade": 0.2}}}]}')) == (None, 0.3)
    # A preferred key that is present but null decides, too.
    assert tuple(annotation(spark, '{"colocated_variants": [{"frequencies": {"A": {"gnomade": null, "gnomadg": 0.3}}}]}')) == (None, None)


def test_outside_scores(spark):
    rows = [
        ('{"dbnsfp": {"revel": {"score": 0.5}, "cadd": {"phred": 20.1}}}', 0.5, 20.1),
        ('{"dbnsfp": {"revel": {"score": [0.7, 0.1]}, "cadd": {"phred": [3, 4]}}, "cadd": {"phred": 9}}', 0.7, 3.0),
        ('{"dbnsfp": {"revel": {"score": []}, "cadd": {"phred": []}}, "cadd": {"phred": 9}}', None, None),
        ('{"dbnsfp": {"revel": "none"}, "cadd": {"phred": 9}}', None, 9.0),
        ('{"dbnsfp": {"cadd": {"phred": null}}, "cadd": {"phred": [8.5]}}', None, 8.5),
        ("{}", None, None),
    ]
    found = spark.createDataFrame(rows, "j string, r double, c double").select(
        "r", "c", payload.revel_score(F.col("j")).alias("fr"), payload.cadd_phred(F.col("j")).alias("fc")
    ).collect()
    assert all((row.r, row.c) == (row.fr, row.fc) for row in found)
