import random

from helpers import apply

from tillroll.functions import text


def test_strip_removes_what_python_strips(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert sorted(blanks) == sorted(text.WHITESPACE)
    values = [f"{b}a{b}b{b}" for b in blanks] + ["".join(blanks), "", "a", "​x​", None]
    assert apply(spark, values, text.strip) == [v if v is None else v.strip() for v in values]


def test_title_case_of_product_names(spark):
    values = ["Non-stick Pan", "Shampoo 500ml", "USB-C Hub", "it's", "home & kitchen", "  a b", "", None]
    expected = ["Non-Stick Pan", "Shampoo 500Ml", "Usb-C Hub", "It'S", "Home & Kitchen", "  A B", "", None]
    assert apply(spark, values, text.title_case) == expected


def test_title_case_equals_python_title(spark):
    rng = random.Random(7)
    letters = "abcXYZ  -'&/0129._" + "éÉßǆǅﬁıİ中ⅷⓐж́ᾳ"
    values = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    assert apply(spark, values, text.title_case) == [v.title() for v in values]


def test_reader_tokens_match_before_trimming(spark):
    values = [*text.READER_NULL_TOKENS, " NA ", "na", "NULLS", "x", None]
    got = apply(spark, values, text.null_reader_tokens)
    assert got == [None] * len(text.READER_NULL_TOKENS) + [" NA ", "na", "NULLS", "x", None]


def test_text_tokens_match_after_trimming(spark):
    values = [" nan ", "None\t", " ", " NA ", "NaN ", "Nan", "none", " x "]
    assert apply(spark, values, text.clean_text) == [None, None, None, "NA", "NaN", "Nan", "none", "x"]


def test_categories(spark):
    values = ["Electronic", "Electronics", "Beauty & Personal Care", "Beauty", "Toys", None]
    expected = ["Electronics", "Electronics", "Beauty", "Beauty", "Toys", None]
    assert apply(spark, values, text.canonical_category) == expected


def test_defaults(spark):
    assert apply(spark, [None, "", "x"], lambda c: text.impute(c, "?")) == ["?", "", "x"]
