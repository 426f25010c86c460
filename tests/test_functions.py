import re
from difflib import SequenceMatcher

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varqa.functions import keys
from varqa.functions import text as T


def col(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_words_are_pythons_words(spark):
    texts = ["", "It's a TEST_1, é!", "kâ कि x", "a  b\nc", "مرحبا 12"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.words(F.col("t")).alias("w")).collect()
    for r in rows:
        assert r.w == re.sub(r"[^\w\s]", " ", texts[r.i].lower()).split()


def test_scalars(spark):
    assert col(spark, "'a b'", T.strip_quotes) == "a b"
    assert col(spark, "\n  \n one \ntwo", T.first_line) == "one"
    assert col(spark, "text\n_note one_\n_note two_\n", T.strip_notes) == "text"
    assert col(spark, "Grade: 7 then 2", T.grade) == 2
    assert col(spark, "none", T.grade) == 0
    assert col(spark, "[kb:a] x [kb:b-1]", T.citations) == ["kb:a", "kb:b-1"]
    assert col(spark, "theme_divine_love", lambda c: T.label_of_id(c, "theme_")) == "Divine love"
    assert col(spark, "Event (1680): Born in X. More.", T.body_after_dates) == "Born in X"
    assert col(spark, "Punjabi / Urdu, Persian", T.primary_language) == "Punjabi"
    assert col(spark, "https://a.org/x/y-z?lang=ur", T.slug_of_url) == "y-z"
    assert col(spark, "سلام abc", T.dominant_script) == "arabic"
    assert col(spark, "123", T.dominant_script) == "other"
    assert col(spark, "[Paste or type the text]", lambda c: T.has_placeholder(c)) is True
    assert col(spark, "a [bracket] only", lambda c: T.has_placeholder(c)) is False


def test_token_f1(spark):
    rows = [("a b c", "a b c", 1.0), ("a a b", "b c", 0.5), ("", "a", 0.0), ("x", "y", 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    assert all(abs(r.f - r.want) < 1e-9 for r in df.select("want", T.token_f1(F.col("a"), F.col("b")).alias("f")).collect())


def test_keys():
    assert keys.slugify("Élan  Vital!") == "elan_vital" and keys.slugify("अ") == "untitled"
    assert keys.latin_key("Bāb-e ʿAāli") == keys.latin_key("bab e ali")
    assert keys.latin_key("eee") == "ie" and keys.latin_key("aaaa") == "a"
    assert keys.arabic_key("يـكَ") == "یک"
    assert keys.devanagari_to_latin("किताब") == "kitaba"
    assert keys.devanagari_to_latin("क्या १") == "kya 1"
    assert keys.devanagari_to_latin("ज़") == "za"
    assert keys.latin_style("aakh 'ain\nghain") == "Ākh ʿain\nĠain"


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_style_is_idempotent(t):
    once = keys.latin_style(t)
    assert keys.latin_style(once) == once or "ā" in once or any(x in once for x in ("aa", "ee", "oo", "AA", "Aa", "EE", "Ee", "OO", "Oo"))


@settings(max_examples=100, deadline=None)
@given(st.text("ab c", max_size=30), st.text("ab c", max_size=30))
def test_similarity_is_difflibs(a, b):
    want = 0.0 if not a or not b else SequenceMatcher(None, a, b).ratio() if a != b else 1.0
    assert keys.similarity(a, b) == want


def test_udfs_keep_nulls(spark):
    df = spark.createDataFrame([("Élan",), (None,)], "t string").select(keys.slugify_udf("t").alias("s"))
    assert [r.s for r in df.collect()] == ["elan", None]


def test_letters_make_the_keys_of_the_functions():
    import random
    import re

    from varqa.functions import keys as K

    r = random.Random(4)
    pools = ["aaeeoo AE-'\n\r \x85\x0bß", "اآأيىكۀةہےوؤئٕٔٓـ \n", "éñßœŒǅﬁ①ﾞｶﾊﾟ가각ᅡᆨᄀୋ", "".join(map(chr, [*range(0x20, 0x2FF), *range(0x300, 0x370), *range(0x600, 0x700), *range(0x1F600, 0x1F620)]))]
    breaks = re.compile("\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
    for name, key in (("latin_key", K.latin_key), ("arabic_key", K.arabic_key)):
        for _ in range(400):
            pool = r.choice([*pools, "".join(pools)])
            texts = [r.choice([None, "", "".join(r.choice(pool) for _ in range(r.randint(0, 40)))]) for _ in range(r.randint(0, 6))]
            for lines in (True, False):
                code, size, of = K.LETTERS[name].keys(texts, lines)
                held = code.tobytes().decode("utf-32-le")
                ends = size.cumsum().tolist()
                got = [(i, held[e - n : e]) for i, e, n in zip(of.tolist(), ends, size.tolist())]
                assert sorted(got) == sorted((i, k) for i, t in enumerate(texts) for x in (breaks.split(t or "") if lines else [t or ""]) if (k := key(x)))


def test_no_key_has_what_normalisation_reorders():
    import unicodedata

    from varqa.functions import keys as K

    assert not any(chr(c).translate(K._LATIN) for c in range(0x110000) if unicodedata.combining(chr(c)))
