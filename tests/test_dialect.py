"""Dialect detection and strict reading of separated text files."""

import gzip
import os

import pytest

from odflow import schema as S
from odflow.sources import dialect, files


def of(text, **kw):
    return dialect.sniff(text.encode(kw.pop("encoding", "utf-8")), **kw)


@pytest.mark.parametrize("sep", list("\t|;,"))
@pytest.mark.parametrize("quote", ['"', "'", ""])
def test_separator_and_quote(sep, quote):
    # values hold the other separators, and the own one where quotes allow it
    other = "".join(s for s in "\t|;," if s != sep) + (sep if quote else "")
    rows = [f"name{sep}{quote}label{quote}{sep}value"] + [f"n{i}{sep}{quote}a{other} {i}{quote}{sep}{i}.5" for i in range(9)]
    d = of("\n".join(rows) + "\n")
    assert (d.sep, d.columns, d.header) == (sep, ("name", "label", "value"), True)
    assert not quote or d.quote == quote


def test_thousands_separators_do_not_make_columns():
    d = of("code;total\n01001;1,234\n01002;12,345\n01003;2,000\n")
    assert d.sep == ";" and d.columns == ("code", "total")
    d = of(',Total\n44001 Ababuj,"1,234"\n44002 Abejuela,"5,678"\n')
    assert d.sep == "," and d.columns == ("column0", "Total")


def test_names_asked_for_outweigh_evenness():
    text = "a|b\n1,5|x,y\n2,5|y,z\n3,5|z,z\n"
    assert of(text, names=("a", "b")).columns == ("a", "b")


def test_header_or_not():
    assert not of("1|2|3\n4|5|6\n").header and of("1|2|3\n4|5|6\n").columns == ("column0", "column1", "column2")
    assert of("a|b\nx|y\nz|y\n").header
    assert not of("x|y\nz|y\n").header          # y occurs again in its column
    assert of("x|y\nz|y\n", names=("x",)).header
    assert not of("a|b\nx|y\n", names=("id",)).header
    assert of("a|a|\n1|2|3\n").columns == ("a", "a_1", "column2")


def test_encodings():
    assert of("cañada;n\nä;1\n").encoding == "UTF-8"
    assert of("cañada;n\nä;1\n", encoding="latin-1").encoding == "ISO-8859-1"
    assert of("﻿id;n\nä;1\n").columns == ("id", "n")
    cut = "id;n\nä;1\nñ".encode()[:-1]          # a character cut at the sample's end
    assert dialect.sniff(cut, whole=False).encoding == "UTF-8"


def test_a_cut_last_line_does_not_count():
    text = "a|b|c\n" + "1|2|3\n" * 5 + "1|2"
    assert dialect.sniff(text.encode(), whole=False).columns == ("a", "b", "c")


@pytest.mark.parametrize("text", ["", "\n \n", "one\ntwo\nthree\n"])
def test_nothing_to_agree_on(text):
    with pytest.raises(dialect.UnknownDialect):
        of(text)
    if text.strip():
        assert of(text, sep=";").columns


def _put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    opener = gzip.open if name.endswith(".gz") else open
    with opener(os.path.join(folder, name), "wb") as f:
        f.write(text.encode(encoding))


def test_files_of_several_dialects_in_one_read(spark, scratch):
    _put(scratch, "a.csv", 'id,label,n\n01,"x, y",1\n02,"say ""hi""",2\n')
    _put(scratch, "b.csv.gz", "n;extra;label;id\n3;-;'p; q';03\n")
    _put(scratch, "c.txt", "label|id|n\nñandú|04|4\n", "latin-1")
    _put(scratch, "d.csv", "label|id|n\nuno|05|\ndos|06|6\n")
    _put(scratch, "empty.csv", "")
    rows = {tuple(r) for r in files.read_detected(spark, scratch, ["id", "label", "n"]).collect()}
    assert rows == {("01", "x, y", "1"), ("02", 'say "hi"', "2"), ("03", "p; q", "3"), ("04", "ñandú", "4"), ("05", "uno", None), ("06", "dos", "6")}


def test_all_files_empty(spark, scratch):
    _put(scratch, "a.csv", "")
    assert files.read_detected(spark, scratch, ["id"]).columns == ["id"] and files.read_detected(spark, scratch, ["id"]).count() == 0


@pytest.mark.parametrize("line", ["01002 B", "01003 C,5,6,7", "01004 D,1,200"])
@pytest.mark.parametrize("read", ["stat", "varchar"])
def test_ragged_lines_fail_with_file_and_fields(spark, scratch, line, read):
    good = "".join(f"{i:05d} A,{i}\n" for i in range(5, 50))
    _put(scratch, "ragged.csv", "column0,Total\n" + good + line + "\n")
    schema = S.T.StructType([S.T.StructField(c, S.T.StringType()) for c in ("column0", "Total")])
    df = (files.read_stat_csv(spark, scratch, ["column0", "Total"]) if read == "stat" else files.read_all_varchar(spark, scratch, schema, ","))
    for action in (df.collect, df.count, df.select("Total").collect):
        with pytest.raises(Exception) as e:
            action()
        assert "ragged.csv" in str(e.value) and line.split(",")[0] in str(e.value)


def test_a_ragged_line_after_the_sample_fails(spark, scratch):
    _put(scratch, "long.csv", "a;b\n" + "x;1\n" * 60_000 + "x;1;2\n")
    with pytest.raises(Exception, match="long.csv"):
        files.read_detected(spark, scratch, ["a", "b"]).collect()


def test_missing_column_and_differing_columns(spark, scratch):
    _put(scratch, "a.csv", "id;n\n1;2\n3;4\n")
    with pytest.raises(S.ContractError, match="a.csv"):
        files.read_detected(spark, scratch, ["id", "total"])
    _put(scratch, "b.csv", "id;n;m\n1;2;3\n3;4;5\n")
    with pytest.raises(S.ContractError):
        files.read_detected(spark, scratch)


def test_head_reads_through_compression(spark, scratch):
    from odflow.sources import storage
    _put(scratch, "a.csv.gz", "x" * 100_000)
    _put(scratch, "b.csv", "héllo")
    assert storage.head(spark, f"{scratch}/a.csv.gz", 10) == b"x" * 10
    assert storage.head(spark, f"{scratch}/b.csv", 100) == "héllo".encode()
