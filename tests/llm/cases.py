"""Edge cases that the corpus tests share."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, row string, t string, "
          "w string, fp string, place string, key string, token string, n_words string, kept string, cell string")
CLEAN = ("The quick survey of {a} rivers near {b} shows that water levels rise every spring, while farmers in the "
         "valley store grain, repair old bridges and plan their markets around the season; nobody expects a dry year, "
         "yet each village keeps one deep well, two granaries and a long list of neighbours who might need help when "
         "the {c} road closes for winter.")


def clean(i: int) -> str:
    return CLEAN.format(a=f"river{i}", b=f"town{i * 7}", c=f"mountain{i * 13}")


def edge_texts() -> list:
    """Null, empty, blank, very short, repeated, near-equal, odd characters, and one very long text."""
    plain = [clean(i) for i in range(70)]
    long_ = " ".join(f"word{i % 997} and{i}" for i in range(15_000))
    return [None, "", " ", "\n\t \x0b\x0c\r", "one", "one two", "a b c", "a b c", plain[0], plain[0] + " extra", *plain,
            "Ünïcode wörds 数字 \U0001F600  nbsp line ▁mark  two  spaces\x00\x1cctl", long_,
            "same line\nsame line\nsame line\n\n\nother", "x " * 300, "MIT License", "Apache License. CC BY, cc-by",
            "licensed under the GNU General Public License, version 3."]
