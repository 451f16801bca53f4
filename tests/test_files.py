import gzip
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from umbral.plans import load_catalog
from umbral.sources import files as S
from umbral.sources import references as H
from umbral.sources import sinks as W


def put(path, text):
    (gzip.open(path, "wt") if str(path).endswith(".gz") else open(path, "w")).write(text)
    return str(path)


@pytest.mark.parametrize("name", ["x.fa", "x.fa.gz"])
def test_fasta(spark, rows, tmp_path, name):
    p = tmp_path / name
    with (gzip.open(p, "wt") if name.endswith("gz") else open(p, "w")) as fh:
        fh.write(">a one\nAC\nGT \n>b\n>c x>y\nTT\n")
    assert rows(S.read_fasta(spark, str(p))) == [("a", "ACGT"), ("b", ""), ("c", "TT")]


def test_fasta_without_id_raises(spark, tmp_path):
    with open(tmp_path / "e.fa", "w") as fh:
        fh.write(">a\nA\n> \nC\n")
    with pytest.raises(Exception, match="empty FASTA header"):
        S.read_fasta(spark, str(tmp_path / "e.fa")).collect()


def test_reference_entries_keep_file_order(spark, tmp_path):
    with open(tmp_path / "t.faa", "w") as fh:
        for i in range(30):
            fh.write(f">T{i}|type_II_{'AT' if i % 2 else 'T'} h\nmk {i}v*\n")
    e = H.reference_entries(spark, "tadb", str(tmp_path / "t.faa")).orderBy("key").collect()
    assert [(r.key, r.subject) for r in e] == [(i, f"T{i}") for i in range(30)]
    assert e[1].seq == "MK1V" and e[1].labels[0].label == "type II antitoxin"


@pytest.mark.parametrize("source,header,expected", [
    ("oritdb", "relaxase_1 TraI_RP4 more MOBP id=3", ("TraI_RP4", [("relaxase", "MOBP")])), ("oritdb", "t4cp_2 X id=1", ("X", [("T4CP", "")])),
    ("oritdb", "auxiliary_9 Y a _ id=1", ("Y", [("auxiliary protein", "")])),
    ("mobileog", "m1|n|u|transfer|conj|Plasmid RefSeq|Homology", ("m1", [("transfer", "conj; evidence=Homology")])),
    ("dbapis", "A1 gene=NA family=F1,F2 evidence=homolog d", ("A1", [("F1", "evidence=homolog"), ("F2", "evidence=homolog")])),
    ("acrdb", "anti1 family=AcrIF1 type=I-F acc=Z evidence=Verified", ("anti1", [("AcrIF1", "I-F; evidence=Verified")]))])
def test_header_grammars(spark, source, header, expected):
    r = H.parse_headers(spark.createDataFrame([(header,)], "header string"), source).first()
    assert (r.subject, [tuple(x) for x in r.labels]) == expected


@pytest.mark.parametrize("source,header", [("tadb", "T1|type_2_T x"), ("oritdb", "other_1 a b"), ("dbapis", "A gene=g evidence=x"), ("acrdb", "a family=F")])
def test_bad_headers_raise(spark, source, header):
    with pytest.raises(Exception, match="header"):
        H.parse_headers(spark.createDataFrame([(header,)], "header string"), source).collect()


def test_commented_tables_meet_their_own_header(spark, rows, tmp_path):
    d = tmp_path / "sys"
    os.makedirs(d)
    for name, text in {"a.tsv": "# c\n\nhit_id\tgene_name\nh1\tg1\n\tg0\n", "b.tsv": "# only\n# comments\n", "c.tsv": "#x\ngene_name\thit_id\tmodel_fqn\ng2\th2\tm\n"}.items():
        with open(d / name, "w") as fh:
            fh.write(text)
    t = S.read_commented_tsv(spark, str(d), ["hit_id", "gene_name", "model_fqn", "hit_i_eval"])
    assert rows(S.component_hits(t)) == [("h1", "g1", "", ""), ("h2", "g2", "m", "")]


def test_order_holds_over_many_splits(spark, tmp_path):
    """Small splits are read in any order; numbers and headers still follow the file."""
    with open(tmp_path / "is", "w") as fh:
        fh.write("seqID\tfamily\tcluster\tisBegin\tisEnd\tstrand\tE-value\ttype\ttir\n" + "".join(f"r1\tF{i}\tc\t{i}\t9\t+\t1\tp\t-:-\n" for i in range(400)))
    with open(tmp_path / "sys.tsv", "w") as fh:
        fh.write("# c\nhit_id\tgene_name\n" + "".join(f"h{i}\tg{i}\n" for i in range(400)))
    with open(tmp_path / "x.fa", "w") as fh:
        fh.write("".join(f">s{i}\nACGTACGT\n" for i in range(400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = {r.is_id: r.family for r in S.read_is_elements(spark, str(tmp_path / "is")).collect()}
        assert got == {f"r1|IS{i + 1}": f"F{i}" for i in range(400)}
        t = S.read_commented_tsv(spark, str(tmp_path / "sys.tsv"), ["hit_id", "gene_name"]).collect()
        assert sorted((r.hit_id, r.gene_name) for r in t) == sorted((f"h{i}", f"g{i}") for i in range(400))
        f = [r.header for r in S.read_fasta_full(spark, str(tmp_path / "x.fa")).orderBy("file_order").collect()]
        assert f == [f"s{i}" for i in range(400)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_integrons_and_elements(spark, rows, tmp_path):
    cols = "\t".join(["ID_integron", "ID_replicon", "element", "pos_beg", "pos_end", "strand", "evalue", "type_elt", "annotation", "model", "type", "default", "distance_2attC", "considered_topology"])
    with open(tmp_path / "i", "w") as fh:
        fh.write("# no\n" + cols + "\nint1\tr1\te\t5\t90\t1\t0\tattC\ta\tm\tCALIN\tYes\t1\tlin\n")
    assert rows(S.read_integrons(spark, str(tmp_path / "i")), "plasmid_id", "start", "end", "integron_type") == [("r1", 5, 90, "CALIN")]
    with open(tmp_path / "bad", "w") as fh:
        fh.write("int1\tr1\te\n")
    with pytest.raises(Exception, match="expected 14 columns"):
        S.read_integrons(spark, str(tmp_path / "bad")).collect()
    with open(tmp_path / "is", "w") as fh:
        fh.write("seqID\tfamily\tcluster\tisBegin\tisEnd\tstrand\tE-value\ttype\ttir\nr1\tIS3\tc\t1\t9\t \t1e-5\tc\t-:-\nr2\tIS4\tc\t1\t9\t+\t1\tp\tA:T\nr1\tIS1\tc\t4\t8\t-\t1\tp\tA:T\n")
    assert rows(S.read_is_elements(spark, str(tmp_path / "is")), "is_id", "family", "strand", "complete", "tir") == [("r1|IS1", "IS3", "", 1, ""), ("r1|IS2", "IS1", "-", 0, "A:T"), ("r2|IS1", "IS4", "+", 0, "A:T")]


def test_emapper(spark, tmp_path):
    with open(tmp_path / "e", "w") as fh:
        fh.write("## v\n#query\tCOG_category\tPFAMs\tKEGG_ko\nq1\tLK\tA, B\t-\nq2\t-\n## Total time\n")
    got = {r.query: r for r in S.read_emapper(spark, str(tmp_path / "e")).collect()}
    assert set(got) == {"q1", "q2"} and got["q1"].pfams == ["A", "B"] and got["q1"].kegg_ko == [] and got["q2"].cog_category is None and got["q2"].pfams == []


def test_stockholm_json_taxdump(spark, rows, tmp_path):
    with open(tmp_path / "p.dat", "w") as fh:
        fh.write("# STOCKHOLM 1.0\n#=GF ID   A_N\n#=GF DE   first  one\n#=GF CL   CL1\n//\n#=GF ID   B\n#=GF DE   two\n//\n#=GF DE   no id\n//\n")
    assert rows(S.read_stockholm(spark, str(tmp_path / "p.dat"))) == [("A_N", "first  one", "CL1"), ("B", "two", "")]
    model = lambda typ: {"model_type": typ, "model_name": "TEM-1", "ARO_accession": "30", "ARO_category": {"1": {"category_aro_name": "fam b", "category_aro_class_name": "AMR Gene Family"}, "2": {"category_aro_name": "fam a", "category_aro_class_name": "AMR Gene Family"}, "3": {"category_aro_name": "d", "category_aro_class_name": "Drug Class"}},
                         "model_sequences": {"sequence": {"9": {"protein_sequence": {"sequence": "mk"}}}}, "model_param": {"blastp_bit_score": {"param_value": "500"}}}
    with open(tmp_path / "m.json", "w") as fh:
        json.dump({"_version": "3", "1": model("protein homolog model"), "2": model("protein variant model")}, fh)
    m = S.read_models_json(spark, str(tmp_path / "m.json")).collect()
    assert len(m) == 1 and (m[0].key, m[0].subject, m[0].sequence, m[0].cut_off, [x.label for x in m[0].labels]) == ("1", "ARO:30", "MK", 500.0, ["fam a", "fam b"])
    with open(tmp_path / "n.dmp", "w") as fh:
        fh.write("1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tBosea\t|\tx\t|\tsynonym\t|\n")
    with open(tmp_path / "o.dmp", "w") as fh:
        fh.write("1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tgenus\t|\n")
    n, o = S.read_taxdump(spark, str(tmp_path / "n.dmp"), str(tmp_path / "o.dmp"))
    assert rows(n) == [(1, "root", "scientific name"), (2, "Bosea", "synonym")] and rows(o) == [(1, 1), (2, 1)]


def test_edges_fail_fast(spark, rows, tmp_path):
    with open(tmp_path / "d", "w") as fh:
        fh.write("a\tb\t0.01\t1e-20\t9/10\na\ta\t0\t0\t1\na\tc\t0.01\t1e-5\t1\nb\tc\t0.06\t0\t1\n")
    assert rows(S.read_edges(spark, str(tmp_path / "d"))) == [("a", "b")]
    with open(tmp_path / "x", "w") as fh:
        fh.write("a\tb\tnear\t0\t1\n")
    with pytest.raises(Exception):
        S.read_edges(spark, str(tmp_path / "x")).collect()


def test_map_and_huge_tsv(spark, rows, tmp_path):
    with open(tmp_path / "m", "w") as fh:
        fh.write("s1\tp|1,p|2\ns2\tq|1\n")
    assert rows(S.read_map(spark, str(tmp_path / "m"))) == [("s1", "p|1"), ("s1", "p|2"), ("s2", "q|1")]
    with gzip.open(tmp_path / "h.tsv.gz", "wt") as fh:
        fh.write("id\tseq\n1\t" + "A" * 300_000 + "\n2\t\"x\n")
    got = S.read_huge_tsv(spark, str(tmp_path / "h.tsv.gz"), 3)
    assert rows(got.select("id", F.length("seq").alias("n"))) == [("1", 300_000), ("2", 2)] and got.rdd.getNumPartitions() == 3


def test_sinks_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([("b", None, 1), ("a", "x, \"y\"", 2)], "id string, label string, n int")
    W.write_tsv(df, str(tmp_path / "t"), ["id", "label"], ["id"], "gzip")
    assert rows(S.read_tsv(spark, str(tmp_path / "t"))) == [("a", "x, \"y\""), ("b", None)]
    W.write_report_csv(df, str(tmp_path / "c"), ["id", "label"], ["id"])
    assert rows(spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))) == [("a", "x, \"y\""), ("b", None)]
    seqs = spark.createDataFrame([("a", "ACGT"), ("b", "TT")], "seq_id string, seq string")
    W.to_fasta(seqs, str(tmp_path / "f"), keep=seqs.filter("seq_id = 'a'"))
    assert rows(S.read_fasta(spark, str(tmp_path / "f"))) == [("a", "ACGT")]


@pytest.fixture(scope="module")
def small(spark):
    rec = spark.createDataFrame([("r1", "ACGTACGTACGTA" * 6, 78, "circular"), ("r2", "ACG", 3, "linear")], "plasmid_id string, seq string, length int, topology_word string")
    it = spark.createDataFrame([("r1", "r1|1", 70, 5, -1, "a \"q\"; x", "FUNCTIONAL", "0"), ("r1", "r1|2", 10, 30, 1, None, "NONE", "1")],
                               "plasmid_id string, orf_id string, start int, end int, strand int, annot_label string, functional_class string, partial_begin string")
    return it, rec


def test_gff3_file(spark, small, tmp_path):
    W.to_gff3(*small, str(tmp_path / "g"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "g")).withColumn("f", F.input_file_name()).withColumn("i", F.monotonically_increasing_id()).orderBy("f", "i").collect()]
    assert lines[0] == "##gff-version 3" and lines[1] == "##sequence-region r1 1 78"
    assert lines[2].split("\t") == ["r1", "umbral", "CDS", "1", "5", ".", "-", "0", "ID=r1|1;product=a \"q\"%3B x;functional_class=FUNCTIONAL"]
    assert lines[4].split("\t")[3:8] == ["70", "78", ".", "-", "1"] and lines[3].endswith("ID=r1|2;functional_class=NONE")


def test_genbank_file(spark, small):
    rec = [r.value for r in W.genbank_lines(*small).filter("plasmid_id = 'r1'").orderBy("block", "at").collect()]
    assert rec[0].startswith("LOCUS       r1                        78 bp    DNA     circular UNK ") and rec[-1] == "//"
    assert "     CDS             <10..30" in rec and "     CDS             complement(join(70..78,1..5))" in rec
    assert '                     /product="a ""q""; x"' in rec
    at = rec.index("ORIGIN")
    assert rec[at + 1] == "        1 acgtacgtac gtaacgtacg tacgtaacgt acgtacgtaa cgtacgtacg taacgtacgt" and rec[at + 2].startswith("       61 ") and len(rec) == at + 4


def test_genbank_lines_of_any_letters(spark, rows):
    """A line end or a letter outside the basic plane is one letter of its ten; a long record keeps every line."""
    odd, long = "AB\rDEFGHIJKL MNOPQRST\U0001d504V", "ACGTTGCAAC" * 30_000
    rec = spark.createDataFrame([("o", odd, len(odd), "linear"), ("l", long, len(long), "linear"), ("e", "", 0, "linear")], "plasmid_id string, seq string, length int, topology_word string")
    it = spark.createDataFrame([], "plasmid_id string, orf_id string, start int, end int, strand int, annot_label string, functional_class string")
    got = rows(W.genbank_lines(it, rec).filter("block = 3").select("plasmid_id", "at.a", "value"))
    assert [r for r in got if r[0] == "o"] == [("o", 0, "        1 ab\rdefghij kl mnopqrs t\U0001d504v")]
    ls = [r[2] for r in got if r[0] == "l"]
    assert len(ls) == 5_000 and set(x[10:] for x in ls) == {" ".join(["acgttgcaac"] * 6)} and ls[-1].startswith("   299941 ")
    assert not [r for r in got if r[0] == "e"]


def test_genbank_lines_go_letter_by_letter(spark, rows, tmp_path):
    """As in SQL: a capital's small letter does not follow its neighbours, any space at the end of a line goes, an empty text has one line."""
    texts = ["", "ΟΔΟΣ ΟΔΟΣ", "İ" * 61, "Ab 　", "c" * 59 + " d", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = load_catalog().QUERIES["genbank_sequence_lines"](spark, str(tmp_path))
    want = con.execute(f"SELECT doc_id, line_no, value FROM ({load_catalog().ORACLES['genbank_sequence_lines']}) ORDER BY 1, 2").fetchall()
    assert rows(got, "doc_id", "line_no", "value") == want and len(want) == 7
