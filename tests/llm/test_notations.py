"""Secrets in each notation, licences with like notices, long runs of white space."""

import random

import pytest

LITERAL = "q8Zt7Lw2Xc9Vb4Nm"


@pytest.mark.parametrize("code", [
    'db_password: str = "{}"', 'const authToken: string = "{}"', 'var token string = "{}"', 'config["client_secret"] = "{}"',
    "os.environ['DB_PASSWORD'] = '{}'", 'signing_key = b"{}"', 'auth_key = """{}"""', "auth_key = '''{}'''", 'client_key = ("{}")',
    'client_key = os.getenv("K", "{}")', 'client_key = Secret("{}")', "<password>{}</password>", '<password type="x"> {} </password>',
    "export DB_PASS={}", 'user.setPassword("{}")', "postgres://u:{}@host/db", "let api_token: &'static str = \"{}\";",
    'password: list[str] = "{}"', '"client_secret": "{}"', "client-secret => '{}'", 'A = "{}"\nB = A\nclient_key = B'])
def test_secret_notations(code):
    from sparktrail.llm.secret_scan import scan

    text = "# some lines before\n" + code.format(LITERAL) + "\n# and after"
    at = text.index(LITERAL)
    assert any(s <= at and at + len(LITERAL) <= e for s, e, _ in scan(text)["places"]), scan(text)["spans"]


def test_secret_literals_in_parts_and_with_spaces():
    from sparktrail.llm.secret_scan import redacted, scan

    text = 'client_key = "q8Zt7Lw2" + "Xc9Vb4Nm"'
    assert scan(text)["spans"] == f"lexed:{text.index('q8')}:{len(text) - 1}"
    text = 'password = "correct horse battery staple" # x'
    assert "horse" not in redacted(text, scan(text)["places"])
    for plain in ('title = "{}"', 'key = os.getenv("DATABASE_PASSWORD_NAME")', "a plain text, with a key and a secret garden",
                  "see http://host:8080/path and mail me@host"):
        assert scan(plain.format(LITERAL))["spans"] == ""


def test_secret_letters_are_ascii_only():
    from sparktrail.llm.secret_scan import scan

    assert scan("to\u212Aen=abcdefgh \u017Fecret=abcdefgh")["n_assign"] == 0 and scan("TOKEN=abcdefgh")["n_assign"] == 1


@pytest.mark.parametrize("start", ["token: x[", 'token="""', "<a ", "x://", "token = (", "key: ", 'token["', "const a ", 'a="b"+'])
def test_secret_lexing_takes_linear_time(start):
    import time

    from sparktrail.llm.secret_scan import scan

    before = time.process_time()
    scan("token " + start * 30_000)
    assert time.process_time() - before < 10


def test_licences_with_like_notices():
    from sparktrail.llm.license_scan import NOTICES, TEMPLATES, Scanner

    scan = Scanner().scan
    for label, text in [*TEMPLATES.items(), *NOTICES]:
        x = scan("some words first. " + text + " And then code.")
        assert {s[0] for s in x["spans"]} == {label} and x["score"] > 0.74
    of = lambda text: {s[0] for s in scan(text)["spans"]}
    for name, label in (("General", "gpl"), ("Lesser General", "lgpl"), ("Affero General", "agpl")):
        assert of(f"it under the terms of the GNU {name} Public License as published by the Free Software Foundation") == {label}
    assert of("Licensed under CC BY-SA 3.0") == {"cc-by-sa"} and of("under CC BY-NC-ND 2.0 terms") == {"cc-by-nc-nd"}
    mit = next(t for k, t in NOTICES if k == "mit")
    both = scan(f"{mit} code code code {TEMPLATES['apache']} code {mit}")["spans"]
    assert sorted(s[0] for s in both) == ["apache", "mit", "mit"]


def test_token_ids_of_long_white_space():
    from sparktrail.llm.token_counts import VOCABULARY, encoder, token_ids

    encoding, sizes = encoder(VOCABULARY)
    rnd = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "B1", "!", "\u3000", "\x1c", "\x85", "é"]
    for _ in range(2000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(40)))
        assert token_ids(encoding, text, 3) == encoding.encode_ordinary(text)
    for text in (" " * 1_200_000 + "a", "\n" * 1_200_000 + "b", "c" + " " * 1_200_000):
        assert sizes[token_ids(encoding, text)].sum() == len(text)
