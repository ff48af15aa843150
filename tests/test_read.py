"""Reading change files: order, types, NULL tokens, quoting, compression, encryption, record size."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import ChangeError, Column, ReadOptions
from changeloom.functions.types import spark_type
from changeloom.operators.merge import SEQ
from changeloom.sources import change_files, sealed
from changeloom.sources.change_files import read_changes, read_checked
from changeloom.sources.sealed import write_sealed

TOKEN = "nil-7f3a"
KEY = b"0123456789abcdef0123456789abcdef"


def put(path, text):
    data = text if isinstance(text, bytes) else text.encode()
    path.write_bytes(data)
    return str(path)


def cols(text):
    out = []
    for item in text.split():
        name, type_name = item.split(":")
        out.append(Column(name, spark_type(type_name)))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def encrypt(spark, plain, key=KEY):
    df = spark.createDataFrame([(bytearray(plain), bytearray(key))], "p binary, k binary")
    return bytes(df.select(F.aes_encrypt("p", "k", F.lit("CBC"), F.lit("PKCS"))).first()[0])


def test_types_and_requested_order(spark, tmp_path):
    path = put(tmp_path / "a.csv", "name,id,age\nAnn,1,30\nBob,2,41\n")
    df = read_changes(spark, path, cols("id:INT name:STRING age:SHORT"))
    assert [f.dataType for f in df.schema] == [T.IntegerType(), T.StringType(), T.ShortType()]
    assert rows(df) == [(1, "Ann", 30), (2, "Bob", 41)]


def test_extra_columns_ignored_and_missing_refused(spark, tmp_path):
    path = put(tmp_path / "a.csv", "x,id,y\n1,2,3\n")
    assert rows(read_changes(spark, path, cols("id:INT"))) == [(2,)]
    with pytest.raises(ChangeError, match="not found in file"):
        read_changes(spark, path, cols("id:INT z:INT"))


def test_detection_widens_integers(spark, tmp_path):
    text = "i,d,b,day,at,utc,s,e\n1,1.5,true,2024-01-02,2024-01-02T03:04:05,2024-01-02T03:04:05Z,x,\n2,2,FALSE,2024-01-03,2024-01-02 03:04:05.5,2024-01-02T03:04:05Z,7,\n"
    path = put(tmp_path / "a.csv", text)
    df = read_changes(spark, path)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert types == {
        "i": "bigint", "d": "double", "b": "boolean", "day": "date",
        "at": "timestamp_ntz", "utc": "timestamp", "s": "string", "e": "string",
    }
    mixed = read_changes(spark, path, [Column("i"), Column("s", T.StringType()), Column("d", T.FloatType())])
    assert [f.dataType.simpleString() for f in mixed.schema] == ["bigint", "string", "float"]


def test_all_types(spark, tmp_path):
    header = "b,sh,i,l,f,d,dec,day,time,at,utc,bin,js"
    line = 'true,-32768,2147483647,-9223372036854775808,1.5,2.25,12345.678,2024-02-29,23:59:58,2024-01-01T10:11:12.5,2024-01-09T04:10:19.156057706Z,aGVsbG8=,"{""a"": 1}"'
    path = put(tmp_path / "a.csv", f"{header}\n{line}\n")
    spec = cols(
        "b:BOOLEAN sh:SHORT i:INT l:LONG f:FLOAT d:DOUBLE day:NAIVE_DATE time:NAIVE_TIME at:NAIVE_DATETIME "
        "utc:UTC_DATETIME bin:BINARY js:JSON"
    ) + [Column("dec", spark_type("DECIMAL", 10, 3))]
    row = read_changes(spark, path, spec).first()
    assert (row.b, row.sh, row.i, row.l, row.f, row.d) == (True, -32768, 2147483647, -(2**63), 1.5, 2.25)
    assert row.day == dt.date(2024, 2, 29) and row.time == dt.time(23, 59, 58)
    assert row.at == dt.datetime(2024, 1, 1, 10, 11, 12, 500000)
    assert bytes(row.bin) == b"hello" and row.js == '{"a": 1}' and row.dec == Decimal("12345.678")
    micros = read_changes(spark, path, spec).select(F.unix_micros("utc")).first()[0]
    assert micros == 1704773419156057  # nanoseconds are cut off, not rounded


def test_integers_may_be_written_as_numbers(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id\n1.5\n2.5\n-1.5\n1e3\n+5\n12.0\n 7 \n")
    assert rows(read_changes(spark, path, cols("id:INT"))) == sorted([(2,), (3,), (-2,), (1000,), (5,), (12,), (7,)], key=repr)
    with pytest.raises(Exception, match="CAST"):
        read_changes(spark, put(tmp_path / "b.csv", "id\n32767.5\n"), cols("id:SHORT")).collect()


@pytest.mark.parametrize("cell", ["abc", "99999999999", "1e"])
def test_bad_value_fails(spark, tmp_path, cell):
    path = put(tmp_path / "a.csv", f"id\n1\n{cell}\n")
    with pytest.raises(Exception, match="CAST"):
        read_changes(spark, path, cols("id:INT")).collect()


def test_decimal_rounds_half_up_and_overflow_fails(spark, tmp_path):
    path = put(tmp_path / "a.csv", "d\n0.125\n-0.125\n")
    column = [Column("d", spark_type("DECIMAL", 3, 2))]
    assert rows(read_changes(spark, path, column)) == [(Decimal("-0.13"),), (Decimal("0.13"),)]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        read_changes(spark, put(tmp_path / "b.csv", "d\n10.00\n"), column).collect()


def test_null_token(spark, tmp_path):
    path = put(tmp_path / "a.csv", f'id,s,n\n1,,\n2,"",5\n3,{TOKEN},{TOKEN}\n4,"{TOKEN}","{TOKEN}"\n5,null,7\n')
    wanted = cols("id:INT s:STRING n:INT")
    with_token = read_changes(spark, path, wanted, ReadOptions(null_value=TOKEN))
    assert rows(with_token) == [(1, "", None), (2, "", 5), (3, None, None), (4, None, None), (5, "null", 7)]
    path = put(tmp_path / "b.csv", 'id,s,bin\n1,,\n2,"",""\n')
    assert rows(read_changes(spark, path, cols("id:INT s:STRING bin:BINARY"))) == [(1, None, None), (2, None, None)]


def test_quoting(spark, tmp_path):
    cells = ['a "quoted" word', "comma, inside", "line\nbreak", "cr\r\nlf", "tab\tand ünïcode ✓", " spaces ", "# no comment", "back\\slash", "'", "a\\"]
    text = "id,s\n" + "".join('%d,"%s"\n' % (i, c.replace('"', '""')) for i, c in enumerate(cells))
    path = put(tmp_path / "it's [1] {x}.csv", text)
    df = read_changes(spark, path, cols("id:INT s:STRING"))
    assert [r.s for r in df.orderBy("id").collect()] == cells
    bare = put(tmp_path / "bare.csv", "s,id\n#x,1\n back\\slash ,2\n")
    assert rows(read_changes(spark, bare, cols("s:STRING id:INT"))) == [(" back\\slash ", 2), ("#x", 1)]


@pytest.mark.parametrize("line", ["1", "1,2,3"])
def test_ragged_record_fails(spark, tmp_path, line):
    path = put(tmp_path / "a.csv", f"a,b\n1,2\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_changes(spark, path, cols("a:INT")).collect()


def test_text_keeps_marker_cells(spark, tmp_path):
    path = put(tmp_path / "a.csv", f"id,n,bin\n1,keep,keep\n2,{TOKEN},aGk=\n")
    df = read_changes(spark, path, cols("id:INT n:INT bin:BINARY"), ReadOptions(null_value=TOKEN), as_text=True)
    assert rows(df) == [("1", "keep", "keep"), ("2", None, "aGk=")]


def test_many_files_keep_their_order_and_headers(spark, tmp_path):
    paths = [
        put(tmp_path / "a b.csv", "id,s\n1,x\n"),
        put(tmp_path / "b.csv", "s,id\ny,2\n"),
        put(tmp_path / "c%20.csv", "id,s\n3,z\n"),
    ]
    df = read_changes(spark, paths, cols("id:INT s:STRING"))
    assert rows(df.select(SEQ, "id", "s")) == [(0, 1, "x"), (1, 2, "y"), (2, 3, "z")]


def zstd(data):
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "zstd") as out:
        out.write(data)
    return sink.getvalue().to_pybytes()


@pytest.mark.parametrize("name", ["a.csv.zst", "a.csv.zstd", "a.csv", "a.bin", "a.csv.gz"])
def test_zstd_is_found_by_content(spark, tmp_path, name):
    text = 'id,s\n1,"x ""y""\nz"\n2,\n'
    wanted = cols("id:INT s:STRING")
    expected = [(1, 'x "y"\nz'), (2, None)]
    assert rows(read_changes(spark, put(tmp_path / name, zstd(text.encode())), wanted)) == expected
    assert rows(read_changes(spark, put(tmp_path / f"plain-{name}", text), wanted)) == expected
    assert read_changes(spark, str(tmp_path / name)).columns == ["id", "s"]


def test_encrypted(spark, tmp_path):
    text = f"s,id,bin\nx,1,aGk=\n{TOKEN},2,\n"
    plain = put(tmp_path / "p.csv.aes", encrypt(spark, text.encode()))
    packed = put(tmp_path / "z.csv.zst.aes", encrypt(spark, zstd(text.encode()), KEY[::-1]))
    options = ReadOptions(null_value=TOKEN, encrypted=True, keys={plain: KEY, packed: KEY[::-1]})
    wanted = cols("id:INT s:STRING bin:BINARY")
    expected = [(1, "x", bytearray(b"hi")), (2, None, bytearray(b""))]
    assert rows(read_changes(spark, plain, wanted, options)) == expected
    both = read_changes(spark, [packed, plain], wanted, options)
    assert rows(both.groupBy(SEQ).count()) == [(0, 2), (1, 2)]
    assert read_changes(spark, plain, (), options).columns == ["s", "id", "bin"]
    with pytest.raises(ChangeError, match="Missing encryption key"):
        read_changes(spark, str(tmp_path / "other"), wanted, options)
    wrong = ReadOptions(keys={plain: b"x" * 32})
    with pytest.raises(Exception):
        read_changes(spark, plain, wanted, wrong).collect()


def test_record_size_limit(spark, tmp_path):
    big = "x" * (25 * 1024 * 1024)
    path = put(tmp_path / "a.csv", f"id,s\n1,{big}\n")
    wanted = cols("id:INT s:STRING")
    with pytest.raises(Exception, match="beyond the record limit"):
        read_changes(spark, path, wanted).select(F.length("s")).collect()
    enough = ReadOptions(max_record_mib=28)
    assert read_changes(spark, path, wanted, enough).select(F.length("s")).first()[0] == len(big)
    packed = put(tmp_path / "z.csv", zstd(f"id,s\n1,{big}\n".encode()))
    with pytest.raises(Exception, match="beyond the record limit"):
        read_changes(spark, packed, wanted).collect()
    assert read_changes(spark, packed, wanted, enough).select(F.length("s")).first()[0] == len(big)
    assert ReadOptions(max_record_mib=1).record_bytes == 24 * 2**20
    assert ReadOptions(max_record_mib=5000).record_bytes == 1024 * 2**20


def test_large_file_is_cut_at_records(spark, tmp_path):
    texts = []
    for i in range(3000):
        texts.append(f'line {i}\n"quoted {i}"\n,\n' * (i % 7) + "\r\n" * (i % 2) + "end\\" + '"' * (i % 3))
    body = "id,s\n" + "".join('%d,"%s"\n' % (i, t.replace('"', '""')) for i, t in enumerate(texts))
    first = put(tmp_path / "big 1.csv", body)
    second = put(tmp_path / "big 2.csv", "id,s\n" + "".join(f"{i},plain\n" for i in range(5000)).rstrip("\n"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_changes(spark, [first, second], cols("id:INT s:STRING"), ReadOptions(split_bytes=1000))
        got = [tuple(r) for r in df.orderBy(SEQ, "id").select(SEQ, "id", "s").collect()]
        alone = read_changes(spark, first, cols("s:STRING id:INT"), ReadOptions(split_bytes=1000))
        assert [r.s for r in alone.orderBy("id").collect()] == [t or None for t in texts]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [(0, i, t or None) for i, t in enumerate(texts)] + [(1, i, "plain") for i in range(5000)]
    assert got == expected


@pytest.mark.parametrize(
    "body",
    [
        'name\n5" pipe\nx\n6" pipe\ny\n',
        'name,n\n5" pipe,1\n"a\n""b"",\n",2\n\n6" x ""y"" "z",3\n"",4\n"""",5\n',
        'name,n\n"a"b,1\n"c""",2\n"d\n""\n",3\r\nx""",4\n,"5\n"\n',
        'name,n\n"\n",1\n"\n""\n,""",2\n"x,""\n,",3\n',
    ],
)
def test_quotes_are_read_alike_on_both_routes(spark, tmp_path, body):
    path = put(tmp_path / "a.csv", body)
    names = cols(" ".join(f"{n}:STRING" for n in body.split("\n")[0].split(",")))
    whole = rows(read_changes(spark, path, names))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert rows(read_changes(spark, path, names, ReadOptions(split_bytes=0))) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(whole) >= 3


@pytest.mark.parametrize("split_bytes", [0, 2**40])
def test_size_limit_counts_cells_that_are_not_read(spark, tmp_path, split_bytes):
    path = put(tmp_path / "a.csv", "id,s\n1,{}\n2,\"{}\"\n".format("x" * 25 * 2**20, "a\n" * 100))
    with pytest.raises(Exception, match="record limit of 24 MiB"):
        read_changes(spark, path, cols("id:INT"), ReadOptions(split_bytes=split_bytes)).collect()
    enough = ReadOptions(split_bytes=split_bytes, max_record_mib=28)
    assert rows(read_changes(spark, path, cols("id:INT"), enough)) == [(1,), (2,)]


@pytest.mark.parametrize("route", ["whole", "split", "sealed"])
@pytest.mark.parametrize(
    "body",
    [
        'id,s\n1,x\n2,"never closed\n3,y\n',
        'id,s\n1,a\n2,"open\n3,c\n4,d',
        'id,s\n1,"a""',
        'id,s\n1,"a"\n2,"b\n""\n',
        '"id",s\n1,a"b\n2,"',
    ],
)
def test_a_quote_that_is_never_closed_fails(spark, tmp_path, body, route):
    fine = put(tmp_path / "fine.csv", 'id,s\n1,"x\n"\n2,5" pipe\n3,"y""z"\n4,""\n')
    path, options = put(tmp_path / "a.csv", body), ReadOptions(split_bytes=0 if route == "split" else 2**40)
    if route == "sealed":
        options = ReadOptions(keys={path: KEY})
        put(tmp_path / "a.csv", encrypt(spark, body.encode()))
    with pytest.raises(Exception, match="not closed"):
        read_changes(spark, [fine, path], cols("id:STRING s:STRING"), options).collect()
    assert len(rows(read_changes(spark, fine, cols("id:INT s:STRING"), options))) == 4


@pytest.mark.parametrize("route", ["whole", "split", "sealed"])
@pytest.mark.parametrize("at", ["header", "cell", "unread"])
def test_bytes_that_are_not_utf8_fail(spark, tmp_path, route, at):
    body = {"header": b"id,s,\xff\n1,a,b\n", "cell": b"id,s,t\n1,a\xff,b\n", "unread": "id,s,t\n1,é,".encode() + b"\xc3\n"}[at]
    path, options = put(tmp_path / "odd name.csv", body), ReadOptions(split_bytes=0 if route == "split" else 2**40)
    if route == "sealed":
        options = ReadOptions(keys={path: KEY})
        put(tmp_path / "odd name.csv", encrypt(spark, body))
    with pytest.raises(Exception, match="odd.*name.*not UTF-8"):
        read_changes(spark, path, cols("id:INT s:STRING"), options).collect()


@pytest.mark.parametrize("block", ["5", "1000"])
def test_damage_is_found_across_scan_splits(spark, tmp_path, block):
    fine = put(tmp_path / "fine.csv", 'id,s\n1,"a\n\n\n,""x\n"\n2,5" pipe\n3,"y\n"\n' * 3)
    bad = put(tmp_path / "bad.csv", 'id,s\n1,"a\n\n\n,""x\n"\n2,"5"" pipe\n3,y\n\n\n4,z\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert len(rows(read_changes(spark, fine, cols("id:STRING s:STRING")))) == 11
        with pytest.raises(ChangeError, match="not closed.*bad.csv"):
            read_changes(spark, [fine, bad], cols("id:STRING s:STRING"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_missing_file(spark, tmp_path):
    with pytest.raises(ChangeError, match="Failed to open"):
        read_changes(spark, str(tmp_path / "none.csv"), cols("id:INT"))


def test_decimal_parameters():
    assert spark_type("DECIMAL") == T.DecimalType(18, 3)
    for bad in ((0, 0), (39, 1), (5, 6)):
        with pytest.raises(ChangeError):
            spark_type("DECIMAL", *bad)
    with pytest.raises(ChangeError):
        spark_type("UNSPECIFIED")


def test_bad_cells_are_told_and_good_rows_pass(spark, tmp_path):
    first = put(tmp_path / "1.csv", 'n,id,s,b\n1.5,1,"a\nb",aGk=\nx,2,b,aGk=\n,3,,\n2,z,c,***\n\n3,70000,d,aGk=\n')
    second = put(tmp_path / "2.csv", 's,id,n,b\nt,1,1,aGk=\nshort,2\n"q,",3,4,aGk=,more\nlast,NIL,2.5,aGk=\n')
    wanted = cols("id:SHORT n:DOUBLE b:BINARY s:STRING")
    good, bad = read_checked(spark, [first, second], wanted, ReadOptions(null_value="NIL"))
    assert rows(good.select(SEQ, "id", "n", "s")) == sorted(
        [(0, 1, 1.5, "a\nb"), (0, 3, None, ""), (1, 1, 1.0, "t"), (1, None, 2.5, "last")], key=repr
    )
    found = rows(bad.select("file", "record", "column", "reason", "cell"))
    assert found == sorted(
        [
            (0, 2, "n", "not DOUBLE", "x"),
            (0, 4, "id", "not SHORT", "z"),
            (0, 4, "b", "not BINARY", "***"),
            (0, 5, "id", "not SHORT", "70000"),
            (1, 2, None, "wrong number of cells", "short,2"),
            (1, 3, None, "wrong number of cells", '"q,",3,4,aGk=,more'),
        ],
        key=repr,
    )
    alone, none = read_checked(spark, first, cols("s:STRING"))
    assert alone.columns == ["s"] and alone.count() == 5 and none.count() == 0
    with pytest.raises(ChangeError, match="types"):
        read_checked(spark, first, [Column("id")])


@pytest.mark.parametrize("route", ["split", "sealed"])
def test_bad_cells_of_large_and_sealed_files(spark, tmp_path, route):
    body = "id,s\n" + "".join(f"{k if k % 10 else 'x'},t\n" for k in range(200))
    path = put(tmp_path / "a.csv", encrypt(spark, body.encode()) if route == "sealed" else body)
    options = ReadOptions(split_bytes=0) if route == "split" else ReadOptions(keys={path: KEY})
    good, bad = read_checked(spark, path, cols("id:INT s:STRING"), options)
    assert good.count() == 180 and rows(bad) == [(0, None, "id", "not INT", "x")] * 20


def test_a_record_beyond_the_limit_is_told(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id,s\n1,{}\n2,b\n".format("x" * 25 * 2**20))
    good, bad = read_checked(spark, path, cols("id:INT"))
    assert rows(good) == [(2,)] and rows(bad) == [(0, 1, None, "beyond the record limit of 24 MiB", None)]


def test_sealed_files_are_written_by_executors(spark, tmp_path):
    data = [(k, None if k % 7 == 0 else f'a"{k}\n,é' * (k % 3), k / 2) for k in range(300)]
    df = spark.createDataFrame(data, "id int, s string, n double")
    paths = write_sealed(df, f"{tmp_path}/sealed", KEY, 5, TOKEN)
    assert len(paths) == 5 and b"id,s" not in b"".join((tmp_path / "sealed" / p.rsplit("/", 1)[1]).read_bytes() for p in paths)
    options = ReadOptions(null_value=TOKEN, encrypted=True, keys=dict.fromkeys(paths, KEY))
    assert rows(read_changes(spark, paths, cols("id:INT s:STRING n:DOUBLE"), options).drop(SEQ)) == sorted(data, key=repr)
    (alone,) = write_sealed(df.limit(0), f"{tmp_path}/none", KEY, 5, TOKEN)
    assert rows(read_changes(spark, alone, cols("id:INT"), ReadOptions(keys={alone: KEY}))) == []


def test_sealed_files_stay_small_whatever_repeats(spark, tmp_path):
    data = [(1, "the same text"), *[(k, "w" * (k % 40)) for k in range(50)], (2, "x" * 3000)] + [(1, "the same text")] * 400
    df = spark.createDataFrame(data, "id int, s string").repartition(3)
    paths = write_sealed(df, f"{tmp_path}/sealed", KEY, 2, TOKEN, file_bytes=1000)
    sizes = sorted((tmp_path / "sealed" / p.rsplit("/", 1)[1]).stat().st_size for p in paths)
    # A record beyond the limit has a file for itself; nothing else is left in the folder.
    assert sizes[-1] > 3000 and sizes[-2] <= 1000 + 2 * 16 and len(list((tmp_path / "sealed").iterdir())) == len(paths) > 10
    options = ReadOptions(null_value=TOKEN, encrypted=True, keys=dict.fromkeys(paths, KEY))
    assert rows(read_changes(spark, paths, cols("id:INT s:STRING"), options).drop(SEQ)) == sorted(data, key=repr)


def long_text(newline_at_end=True):
    """Quoted cells over several lines, bytes of several lengths, and lines longer than a piece."""
    records = ["id,s"] + [f'{k},"é{k}\n""x""\n{"ü" * (k % 50)}"' for k in range(300)] + [f'300,"{"y" * 5000}"', "301,z"]
    return "\n".join(records) + "\n" * newline_at_end


@pytest.mark.parametrize(("piece", "newline_at_end"), [(1664, True), (1664, False), (1 << 24, True)])
def test_encrypted_files_are_read_in_ranges(spark, tmp_path, monkeypatch, piece, newline_at_end):
    monkeypatch.setattr(sealed, "PIECE", piece)
    text = long_text(newline_at_end)
    plain = put(tmp_path / "plain.csv", text)
    path, other = put(tmp_path / "a b.csv.aes", encrypt(spark, text.encode())), put(tmp_path / "short.aes", encrypt(spark, b"id,s\n7,t"))
    options = ReadOptions(null_value=TOKEN, encrypted=True, keys={path: KEY, other: KEY})
    expected = rows(read_changes(spark, plain, cols("id:INT s:STRING"), ReadOptions(null_value=TOKEN)))
    assert len(expected) == 302
    assert rows(read_changes(spark, path, cols("id:INT s:STRING"), options)) == expected
    both = read_changes(spark, [other, path], cols("id:INT s:STRING"), options)
    assert rows(both.filter("id = 7").select(SEQ, "s")) == [(0, "t"), (1, 'é7\n"x"\n' + "ü" * 7)]


def test_ranges_are_tasks_of_their_own_and_a_wrong_key_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sealed, "PIECE", 1664)
    path = put(tmp_path / "a.aes", encrypt(spark, long_text().encode()))
    options = ReadOptions(null_value=TOKEN, encrypted=True, keys={path: KEY})
    files = change_files._opened(spark, [path], options)
    cut = sealed.cut_lines(spark, files, options, 1 << 20)
    assert cut.select(F.spark_partition_id().alias("p")).distinct().count() > 8
    with pytest.raises(Exception, match="AES|BadPadding|UTF-8|header"):
        read_changes(spark, path, cols("id:INT s:STRING"), ReadOptions(null_value=TOKEN, encrypted=True, keys={path: KEY[::-1]})).collect()


@pytest.mark.parametrize("piece", [700, 1 << 24])
def test_zstd_files_are_read_in_stretches_of_frames(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(sealed, "PIECE", piece)
    text = long_text(newline_at_end=False)
    skipped = (0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"5 by."
    data = text.encode()
    cuts = [*range(0, len(data), 997), len(data)]
    # Frames of several kinds: with the size of their content and without, one without content, one to be skipped.
    frames = [pa.compress(data[a:b], codec="zstd", asbytes=True) if k % 2 else zstd(data[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    packed = put(tmp_path / "many.csv", skipped.join([frames[0], zstd(b""), *frames[1:]]))
    options = ReadOptions(null_value=TOKEN)
    files = change_files._opened(spark, [packed], options)
    used = sealed.cut_lines(spark, files, options, 1 << 20).select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 4 if piece < 1000 else used == 1
    plain = put(tmp_path / "plain.csv", text)
    assert rows(read_changes(spark, packed, cols("id:INT s:STRING"), options)) == rows(read_changes(spark, plain, cols("id:INT s:STRING"), options))


def test_ends_of_frames_follow_from_their_headers(tmp_path):
    random_bytes = bytes(random.Random(1).randbytes(300_000))
    parts = [zstd(b""), zstd(b"a" * 1_000_000), pa.compress(random_bytes, codec="zstd", asbytes=True), zstd(random_bytes)]
    put(tmp_path / "f", b"".join(parts))
    with pa.OSFile(str(tmp_path / "f")) as stream:
        assert list(sealed._frame_ends(stream, "f")) == list(itertools.accumulate(map(len, parts)))
    put(tmp_path / "g", b"".join(parts)[:-3])
    with pa.OSFile(str(tmp_path / "g")) as stream, pytest.raises(ChangeError, match="inside a zstd frame"):
        list(sealed._frame_ends(stream, "g"))
