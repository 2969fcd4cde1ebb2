"""Secret scan: base findings against the plain patterns, added ones against marked texts."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from chainloom.llm import queries, secrets

WIDE = "doc_id bigint, text string, findings string, kind int, spans string"


def base(text):
    text = text or ""
    assign = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    assign += r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [s for _, _, s in sorted(out)]


def added(text):
    return [text[a:b] for kind, a, b, _, _ in secrets.findings(text) if kind == "literal"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('secret_value = "hunter2hunter2"', ["hunter2hunter2"]),
        ('db_pwd = "p@ss!w0rd#1"', ["p@ss!w0rd#1"]),
        ("password => 'tr0ub4dor&3'", ["tr0ub4dor&3"]),
        ('password: str = "corr3ct!horse"', ["corr3ct!horse"]),
        ('cfg["passphrase"] = "opensesame77"', ["opensesame77"]),
        ('{"privateKey": "MIIEvQIBADANBg"}', ["MIIEvQIBADANBg"]),
        ("mysql --passwd h8nter!2x host", ["h8nter!2x"]),
        ("<password>s3cr3t!pw</password>", ["s3cr3t!pw"]),
        ("key: AB12cd\nssh_private_key: |\n  -----BEGIN KEY-----\n  MIIEow==\nnext: 1", ["  -----BEGIN KEY-----\n  MIIEow==\n"]),
        # constants reach sensitive names through names, sums, interpolation and calls
        ('K = "Zx81!kqPw0"\nconnect(user="me", password=K)', ["Zx81!kqPw0"]),
        ('A = "q8#Zk"\nB = "p!2mW"\nclient_secret_value = A + B', ["q8#Zk", "p!2mW"]),
        ('a = "Zx81!kqPw0"\nb = a\nc = b\nauth_token_value = c', ["Zx81!kqPw0"]),
        ('part = "Zx81!kqPw0"\npassword = f"{part}"', ["Zx81!kqPw0"]),
        ('password = os.getenv("DB_PASSWORD", "f4llb@ck!9")', ["f4llb@ck!9"]),
        ('secret_value = (\n  "Zx81!"\n  "kqPw0"\n)', ["Zx81!", "kqPw0"]),
        ('K = "firstOne!1"\npwd = K\nK = "other text"', ["firstOne!1"]),
        # no secrets
        ('password_file = "/etc/app/passwords"', []),
        ('pwd = "changeme"', []),
        ('pwd = "<your password>"', []),
        ('name = "Zx81!kqPw0"', []),
        ("He said: the password is long: very long indeed.", []),
        ("token count: 20000 of them", []),
        ("x = x\npwd = x", []),
        ('pwd = pwd + "a"', []),
        ("", []),
    ],
)
def test_added_findings(text, want):
    assert added(text) == want


def test_no_base_finding_is_said_twice():
    assert added('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"') == []
    assert [f[0] for f in secrets.findings('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"')] == ["assign", "hex"]


def texts():
    rng = random.Random(8)
    bits = ["password", "PassWd", "secret", "ToKen", "api_key", "APIKEY", "ſecret", '"', "'", " ", "  ", ":", "=", "==", "AKIA", "AKIAIOSFODNN7", "EXAMPLE99", "0123456789abcdef", "fe"]
    bits += ["x9-/+_.", "\n", "é漢😀", "K", "(", ")", ",", "{", "}", "</", ">", "--", "|", "\\", "`", "#", "+", "$k", "${a}", "f"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    long = "word " * 60_000 + "passwd='Aa1!Aa1!Aa1!'" + "a" * 300_000 + ":" * 3000 + '"' * 3000 + "= " * 3000
    nested = "a=(" * 60_000 + "</" * 60_000 + "<b>=" * 60_000
    return out + [None, "", long, nested, "token=abcdefgh", "token=abcdefgh", "token=abcdefg", "token=token=abcdefgh", "password = = abcdefghij"]


def test_base_equals_patterns(spark, sf_dir):
    wide = [(i // 2 if i < 9 else i, t, "f", 1, "s") for i, t in enumerate(texts())] + [(None, "passwd:abcdefgh", "f", 1, "s")]
    found = secrets.scan(spark.createDataFrame(wide, WIDE).repartition(3)).collect()
    want = sorted((str(i), base(t)) for i, t, *_ in wide)
    got = sorted((str(r.doc_id), [f"{f.kind}:{f.start}:{f.stop}" for f in r.findings if f.kind != "literal"]) for r in found)
    assert got == want
    assert secrets.scan(spark.createDataFrame([], WIDE)).count() == 0


def test_secret_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: r for r in queries.QUERIES["op11_secret_scan"](spark, sf_dir).collect()}
    assert len(out) == len(rows)
    for r in rows:
        spans = base(r.text)
        mine = out[r.doc_id]
        assert mine.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (mine.n_assign, mine.n_access, mine.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex"))
        assert set(spans) <= set(mine.spans.split(",")) | ({""} if not spans else set())
