import gzip
import json

import pytest
from pyspark.sql import functions as F

from tamarack.plans import gold
from tamarack.sources import payloads, stages, tables


def test_variant_scan(spark, tmp_path):
    path = tmp_path / "variants.txt.gz"
    head = ["AlleleID", "GeneSymbol", "Name", "RS# (dbSNP)", "Assembly", "Start"]
    lines = [
        ["1", "TPMT", 'a "quoted" name', "12", "GRCh38", "5"], ["2", "TPMT", "x", "NA", "GRCh37", "6"],
        ["3", "OTHER", "x", "13", "GRCh38", "7"], ["4", "DPYD", "n/a", "-1", "GRCh38", "nan"], ["5", "na", "x", "1", "GRCh38", "8"],
    ]
    with gzip.open(path, "wt") as out:
        out.write("\n".join("\t".join(line) for line in [head, *lines]) + "\n")
    found = tables.variants(spark, str(path))
    assert found.columns == ["GeneSymbol", "Name", "RS# (dbSNP)", "Start", "Assembly"]
    rows = {(r.GeneSymbol, r.Name, r["RS# (dbSNP)"], r.Start) for r in found.collect()}
    assert rows == {("TPMT", 'a "quoted" name', "12", "5"), ("DPYD", None, "-1", None)}


def test_bulk_table(spark, tmp_path):
    (tmp_path / "bulk.tsv").write_text("id\tRelated Genes\tgene2\n1\tTPMT;X\tq\n2\tXTPMT2\tq\n3\tABC\tTPMT\n4\t\tq\n")
    assert {r.id for r in tables.bulk_table(spark, str(tmp_path / "bulk.tsv"), ["TPMT"]).collect()} == {"1", "2"}
    with pytest.raises(ValueError):
        tables.gene_column(["a", "b"])


def test_stages(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert not stages.is_complete(spark, path)
    first = stages.reuse_or_build(spark, path, lambda: spark.range(3))
    assert stages.reuse_or_build(spark, path, lambda: 1 / 0).count() == first.count() == 3
    of = stages.manifest(rows=spark.range(5), least=1)
    assert stages.reuse_or_build(spark, path, lambda: spark.range(5), of).count() == 5
    assert stages.reuse_or_build(spark, path, lambda: 1 / 0, of).count() == 5
    assert stages.reuse_or_build(spark, path, lambda: spark.range(6), stages.manifest(rows=spark.range(5), least=2)).count() == 6
    assert not stages.write_side_table(spark.range(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    assert stages.write_side_table(spark.range(1), str(tmp_path / "some"))
    assert not stages.write_side_table(spark.range(0), str(tmp_path / "some")) and not (tmp_path / "some").exists()
    by = spark.range(6).withColumn("gene", F.when(F.col("id") < 4, "a").otherwise("b"))
    stages.write_table(by, str(tmp_path / "by"), partition_by=["gene"])
    assert spark.read.parquet(str(tmp_path / "by")).groupBy("gene").count().count() == 2


def test_manifests_differ_where_inputs_do(spark, tmp_path):
    rows = lambda *given: spark.createDataFrame(list(given), "id int, name string")
    of = lambda df, **more: sorted(stages.manifest(table=df, **more))
    assert of(rows((1, "x"), (2, "y"))) == of(rows((2, "y"), (1, "x")))
    in_memory = [rows((1, "x")), rows((2, "x")), rows((1, "x"), (1, "x")), rows((1, None)), rows((1, "null")), rows().limit(0)]
    joined = [rows((1, "x")).join(rows((1, other)).withColumnRenamed("name", "other"), "id") for other in "xy"]
    local = [spark.sql(f"select * from values (1, 'x'), (2, '{name}') as v(id, name)") for name in "xy"]
    maps = [rows((1, "x")).select(F.create_map(F.lit("k"), F.lit(v)).alias("m")) for v in "xy"]
    # The difference is in a column far beyond what a printed plan shows.
    wide = [spark.range(1).select(*[F.lit(i + (i == 36) * more).alias(f"c{i}") for i in range(40)]) for more in (0, 1)]
    long = [spark.range(1).filter(F.col("id").isin([*range(3000), last])) for last in (3001, 3002)]
    folder = str(tmp_path / "table")
    rows((1, "x")).write.parquet(folder)
    first = of(spark.read.parquet(folder))
    rows((1, "z")).write.mode("overwrite").parquet(folder)
    files = [first, of(spark.read.parquet(folder)), of(spark.read.parquet(folder).filter("id > 0")), of(spark.read.parquet(folder), least=1)]
    every = [*map(of, [*in_memory, *joined, *local, *maps, *wide, *long]), *files]
    assert len({repr(m) for m in every}) == len(every)
    assert of(spark.range(1).select(*[F.lit(i).alias(f"c{i}") for i in range(40)])) == of(wide[0])


def test_a_stage_of_other_rows_is_made_again(spark, tmp_path):
    path = str(tmp_path / "stage")
    for row in ((1, "x"), (2, "y"), (2, "y")):
        given = spark.createDataFrame([row], "id int, name string")
        stage = stages.reuse_or_build(spark, path, lambda given=given: given, stages.manifest(rows=given))
        assert [tuple(r) for r in stage.collect()] == [row]


def test_scoring_input(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "gerp_score,Name,GeneSymbol,most_severe_consequence,vep_impact,gnomad_af,phylop100way\n"
        '1.5,"a, ""b""",TPMT,missense_variant,LOW,,0.25\nbad,x,TPMT,missense_variant,LOW,NA,1\n'
    )
    rows = tables.scoring_input(spark, str(tmp_path / "in.csv")).collect()
    assert (rows[0].Name, rows[0].gnomad_af, rows[0].gerp_score) == ('a, "b"', None, 1.5)
    assert (rows[1].gerp_score, rows[1].gnomad_af, rows[1].phylop100way) == (None, None, 1.0)


def test_score_payloads_and_tracks(spark, tmp_path):
    (tmp_path / "scores.json").write_text(json.dumps({"query": "chr1:g.1A>T", "cadd": {"phred": [1, 2]}}) + "\n")
    assert payloads.score_payloads(spark, str(tmp_path / "scores.json")).first().query == "chr1:g.1A>T"
    (tmp_path / "track.bedgraph").write_text("chr1\t0\t10\t0.5\n")
    assert tuple(payloads.score_track(spark, str(tmp_path / "track.bedgraph")).first()) == ("chr1", 0, 10, 0.5)
    (tmp_path / "map.tsv").write_text("1\t1\t10\t2\t11\t20\t-1\t0\n")
    assert payloads.assembly_map(spark, str(tmp_path / "map.tsv")).first().strand == -1


def landed(spark, tmp_path):
    labels = [
        {"accession": "PA356", "data": {"geneSymbol": "TPMT", "haplotypes": [
            {"name": "*1", "functionTerm": "Normal function"}, {"name": " *2", "functionTerm": "No function"},
            {"name": "*3", "functionTerm": "Normal function"}, {"name": "*4", "functionTerm": "Unknown function"}, {"name": "*5"}]}},
        {"accession": "PA128", "data": {"geneSymbol": "WRONG", "haplotypes": [{"name": "*9", "functionTerm": "No function"}]}},
    ]
    (tmp_path / "labels.json").write_text("\n".join(map(json.dumps, labels)))
    grid = [
        ["t", None, None, None], ["l", "v1", "v2", "v3"], ["rsID", "rs1", "rs2", "rs3"], ["TPMT Allele", None, None, None],
        ["*1", "A", "C", "G"], ["*2", "T", "C", None], ["*3", None, "A", None], ["*4", "T", None, "A"], ["*5", None, None, "A"],
    ]
    cells = spark.createDataFrame(
        [("TPMT", i, j, v) for i, line in enumerate(grid) for j, v in enumerate(line)], "gene string, row_idx int, col_idx int, value string"
    )
    columns = ["GeneSymbol", "VariationID", "Name", "RS# (dbSNP)", "Chromosome", "Start", "ReferenceAlleleVCF", "AlternateAlleleVCF"]
    variants = spark.createDataFrame([
        ("TPMT", "v1", "one", "1", "6", "100", "A", "T"), ("TPMT", "v1b", "one more", "1.0", "6", "101", "A", "TT"),
        ("TPMT", "v2", "ambiguous", "2", "6", "102", "C", "A"), ("TPMT", "v3", "unusable", "3", "6", "103", "G", "A"),
        ("DPYD", "v4", "other gene", "1", "6", "104", "G", "A"), ("TPMT", "v5", "no allele", "1", "6", "105", None, "A"),
        ("TPMT", "v6", "no rsid", "-1", "MT", "106", "G", "A"),
    ], ", ".join(f"`{c}` string" for c in columns))
    annotations = [
        {"input": "6 100 rs1 A T . . .", "most_severe_consequence": "old", "src_ord": 1},
        {"input": "6 100 rs1 A T . . .", "most_severe_consequence": "missense_variant", "src_ord": 2,
         "transcript_consequences": [{"impact": "MODERATE"}], "colocated_variants": [{"frequencies": {"T": {"gnomadg": 0.25}}}]},
    ]
    (tmp_path / "ann.json").write_text("\n".join(map(json.dumps, annotations)))
    track = "chrom string, start0 bigint, end0 bigint, value double"
    tables_ = gold.Landed(
        payloads.annotation_payloads(spark, str(tmp_path / "ann.json")),
        spark.createDataFrame([("chr6", 99, 100, 1.5)], track),
        spark.createDataFrame([("6", 90, 110, "6", 190, 210, 1, 0)], payloads.ASSEMBLY_MAP_SCHEMA),
        spark.createDataFrame([("chr6", 199, 201, 2.5)], track),
    )
    return variants, cells, payloads.label_payloads(spark, str(tmp_path / "labels.json")), tables_


def test_whole_gold_build(spark, tmp_path):
    variants, cells, labels, tables_ = landed(spark, tmp_path)
    out = str(tmp_path / "out")
    full = gold.build_gold(spark, out, variants, cells, labels, tables_)
    found = {r.VariationID: (r.function_term, r.defining_allele, r.most_severe_consequence, r.vep_impact, r.gnomad_af, r.phylop100way, r.hg19_start, r.gerp_score) for r in full.collect()}
    # rs1: *2 is usable, *4 is not; rs2: *2 and *3 disagree; rs3: *4 and *5 carry no usable label.
    assert found == {
        "v1": ("No function", "*2", "missense_variant", "MODERATE", 0.25, 1.5, 200, 2.5),
        "v1b": ("No function", "*2", None, None, None, None, 201, 2.5),
    }
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert [r.VariationID for r in read("missing_alleles").collect()] == ["v5"]
    assert [r.VariationID for r in read("missing_scores").collect()] == ["v1b"]
    assert read("rejected_payloads").count() == 1
    assert {r.rsid for r in read("ambiguous_keys").collect()} == {"rs1", "rs2"}  # over all labels, rs1 is reported yet kept
    assert {r.column: r.n_present for r in read("coverage").collect()}["gerp_score"] == 2
    assert gold.build_gold(spark, out, variants, cells, labels, tables_).count() == 2

    pool = gold.build_pool(spark, out, variants, full, tables_)
    assert {r.VariationID for r in pool.collect()} == {"v2", "v3", "v4", "v6"}
    strict = gold.build_gold(spark, str(tmp_path / "strict"), variants, cells, labels, tables_, strict=True)
    assert strict.count() == 0
