from pyspark.sql import functions as F

from cuelake import functions as fn


def one(spark, column, **values):
    cols = [F.lit(value).alias(name) for name, value in values.items()]
    return spark.range(1).select(*cols, F.lit(0).alias("_")).select(column).collect()[0][0]


def test_stamps(spark):
    assert one(spark, fn.srt_to_ms("s"), s="00:17:31,099") == 1_051_099
    assert one(spark, fn.srt_to_ms("s"), s="00:61:31,099") is None
    assert one(spark, fn.ms_to_srt("m"), m=1_051_099) == "00:17:31,099"
    assert one(spark, fn.clock("s", ms=True), s=3661.5) == "01:01:01.500"


def test_label(spark):
    assert one(spark, fn.is_label("t"), t="[Müzik]\n[Gülme sesi]") is True
    assert one(spark, fn.is_label("t"), t="[Gülme sesi]\nÖyle yapma.") is False


def test_turkish(spark):
    assert one(spark, fn.norm_turkish("t"), t="İSMAİL, IŞIK!") == "ismail ışık"
    assert one(spark, fn.norm_text("t"), t="İsmail, geldi_mi 2?") == "ismail geldi_mi 2"
    assert one(spark, fn.tr_key("t"), t="Mecnun'a dön.") == "mecnunadön"


def test_meaningful(spark):
    case = dict(a=1000, b=1080, c=1000, d=1080)
    assert one(spark, fn.meaningful("a", "b", "c", "d"), **case) is True
    assert one(spark, fn.meaningful("a", "b", "c", "d"), a=1000, b=1080, c=1070, d=1150) is False


def test_loop_and_degenerate(spark):
    def words(text):
        return fn.letter_tokens(F.lit(text))

    assert one(spark, fn.has_loop(words("a b a b a b a b"))) is True
    assert one(spark, fn.has_loop(words("a b a b a b c"))) is False
    assert one(spark, fn.is_degenerate(words("x" * 41))) is True
    assert one(spark, fn.is_degenerate(words("a b a c a d a e"))) is True
    assert one(spark, fn.is_degenerate(words("bir iki üç"))) is False


def test_layout_gate(spark):
    assert one(spark, fn.fits_layout(F.lit("Short line."), F.lit(11))) is True
    assert one(spark, fn.fits_layout(F.lit("Short line."), F.lit(10))) is False
    assert one(spark, fn.fits_layout(F.lit("<script>"), F.lit(99))) is False
    assert one(spark, fn.fits_layout(F.lit("word " * 30), F.lit(999))) is False


def test_start_policy(spark):
    policy = fn.start_policy("s", "e", "a")
    assert one(spark, policy, s=1000, e=5000, a=1900) == 1000
    assert one(spark, policy, s=1000, e=5000, a=2600) == 2100
    assert one(spark, policy, s=1000, e=5000, a=6000) == 1000


def test_set_hash_ignores_order_but_not_content(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "a"), (3, "a"), (3, "a")], "g int, t string")
    got = dict(rows.groupBy("g").agg(fn.set_hash(fn.row_hash("t"))).collect())
    assert got[1] == got[2] != got[3]
