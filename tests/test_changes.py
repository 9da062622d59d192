from sparkmarts.operators import changes


def test_fingerprint_sees_duplicate_rows(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (2, "y"), (3, "z")], "k int, v string")
    c = spark.createDataFrame([(3, "z"), (1, "x"), (1, "x")], "k int, v string")
    fa, fb, fc = (changes.table_fingerprint(t).collect()[0] for t in (a, b, c))
    assert fa.hash_xor == fb.hash_xor  # xor alone cancels the pair
    assert fa.hash_sum != fb.hash_sum
    assert tuple(fa) == tuple(fc)  # order-insensitive


def test_table_diff(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k int, v string, w int")
    after = spark.createDataFrame([(1, "a", None), (2, "B", 1), (4, "d", 1), (3, "c", None)], "k int, v string, w int")
    got = {(r.k, r.change_type) for r in changes.table_diff(before, after, ["k"]).collect()}
    assert got == {(2, "changed"), (3, "changed"), (4, "added")}
    got2 = {(r.k, r.change_type) for r in changes.table_diff(after, before, ["k"]).collect()}
    assert (4, "removed") in got2


def test_fingerprint_per_group(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "g int, v string")
    rows = {r.g: r.row_count for r in changes.table_fingerprint(df, ["g"]).collect()}
    assert rows == {1: 2, 2: 1}


def test_no_two_rows_have_one_hash_text(spark):
    pairs = [(("a|=b", "c"), ("a", "b|=c")), (("1:a", ""), ("", "1:a")), ((None, "-"), ("-", None)), (("", None), (None, "")), (("2:ab", "x"), ("2", ":abx"))]
    for a, b in pairs:
        one, other = (spark.createDataFrame([r], "p string, q string") for r in (a, b))
        assert changes.table_fingerprint(one).collect() != changes.table_fingerprint(other).collect()
    nested = "s struct<x:string,y:string>, b binary"
    one = spark.createDataFrame([(("a, b", "c"), b"\xff\x00")], nested)
    for row in ((("a", "b, c"), b"\xff\x00"), (("a, b", "c"), b"\xff")):
        assert changes.table_fingerprint(one).collect() != changes.table_fingerprint(spark.createDataFrame([row], nested)).collect()


def _versions():
    before = [(i, f"v{i}", i % 7 or None) for i in range(400)]
    after = [(i, f"v{i}" if i != 17 else "V", i % 7 or None) for i in range(400) if i != 30] + [(999, "new", None)]
    return before, after, {(17, "changed"), (30, "removed"), (999, "added")}


def test_diff_compares_only_unequal_buckets(spark):
    before, after, want = _versions()
    b, a = (spark.createDataFrame(x, "k int, v string, key_bucket int") for x in (before, after))
    for buckets in (1, 8, 1024):
        assert {(r.k, r.change_type) for r in changes.table_diff(b, a, ["k"], buckets).collect()} == want
    differ = changes.unequal_buckets(b, a, ["k"], ["k", "key_bucket", "v"], 1024)
    assert 1 <= differ.count() <= 3
    assert changes.table_diff(b, b, ["k"]).count() == 0
    # the same key as another type, an equal value as another type, a column that one side lacks
    wide = a.selectExpr("CAST(k AS BIGINT) AS k", "v", "CAST(key_bucket AS DECIMAL(5,2)) AS key_bucket")
    assert {(r.k, r.change_type) for r in changes.table_diff(b, wide, ["k"]).collect()} == want
    assert {(r.k, r.change_type) for r in changes.table_diff(b, b.drop("key_bucket"), ["k"]).collect()} == {
        (k, "changed") for k, _, x in before if x is not None
    }


def test_null_keys_match_nothing(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    assert sorted(r.change_type for r in changes.table_diff(df, df, ["k"]).collect()) == ["added", "removed"]


def test_stored_diff_reads_no_equal_bucket(spark, scratch, monkeypatch):
    from sparkmarts.sources import versions

    before, after, want = _versions()
    path = scratch("hashed")
    made = [changes.save_hashed(spark.createDataFrame(x, "k int, v string, w int"), path, ["k"], 64) for x in (before, after)]
    read = []
    real = versions.read_version
    monkeypatch.setattr(versions, "read_version", lambda s, p, v, only=None: (read.append(only), real(s, p, v, only))[1])
    got = changes.stored_diff(spark, path, made[0].number, made[1].number)
    assert {(r.k, r.change_type) for r in got.collect()} == want
    assert len(read) == 2 and all(1 <= len(x) <= 3 for x in read)
    assert changes.stored_diff(spark, path, made[1].number, made[1].number).count() == 0
    assert read[-1] == []
    assert versions.read_table(spark, path).drop("key_bucket").count() == 400
