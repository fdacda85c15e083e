"""Names aren't secrets, texts in other scripts aren't rejected, and long texts are scanned in linear time."""

import random
import string
import time

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import quality, secrets

DATA = "/root/testdata/sf0.1"
WORDS = (
    "user account service manager request handler payment config default session cache value index table query result token parser client server update remove create delete number string buffer worker "
    "queue event stream filter engine model train batch sample weight layer gradient learning rate epoch vector matrix"
).split()
some = lambda r, n: [r.choice(WORDS) for _ in range(n)]
NAMES = {
    "snake": lambda r: "_".join(some(r, r.randint(3, 4))), "upper": lambda r: "_".join(some(r, r.randint(3, 4))).upper(), "path": lambda r: "/" + "/".join(some(r, r.randint(3, 5))) + r.choice([".py", ".txt", ""]),
    "camel": lambda r: "".join(w.title() if i else w for i, w in enumerate(some(r, r.randint(3, 4)))), "dated": lambda r: "-".join(some(r, 2)) + f"-2024-0{r.randint(1, 9)}-{r.randint(10, 28)}-run{r.randint(1, 99)}",
}
ALPHABETS = {
    "base64": string.ascii_letters + string.digits + "+/", "url": string.ascii_letters + string.digits + "-_", "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "alnum": string.ascii_letters + string.digits,
    "lower": string.ascii_lowercase + string.digits, "upper": string.ascii_uppercase + string.digits, "letters": string.ascii_letters,
}


@pytest.fixture(scope="module")
def ratios(spark):
    return secrets.train(spark.read.parquet(f"{DATA}/documents.parquet"))


def _found(spark, ratios, items):
    df = spark.createDataFrame(list(enumerate(f"see {x} there" for x in items)), "doc_id int, text string")
    return secrets.scan(df, ratios).filter(F.exists("spans", lambda s: s["kind"] == secrets.KINDS.index("markov"))).count()


def test_names_are_no_secrets(spark, ratios):
    r = random.Random(11)
    found = {k: _found(spark, ratios, [f(r) for _ in range(300)]) / 300 for k, f in NAMES.items()}
    assert max(found.values()) <= 0.02, found


def test_random_strings_are_secrets(spark, ratios):
    r = random.Random(12)
    found = {k: _found(spark, ratios, ["".join(r.choice(a) for _ in range(r.choice([20, 24, 31]))) for _ in range(200)]) / 200 for k, a in ALPHABETS.items()}
    assert min(found.values()) >= 0.88 and sum(found.values()) / len(found) >= 0.9, found


def _runs(text, spans):
    """The tokens that share no character with a span, by looking at each."""
    import re

    return [(m.start(), m.end()) for m in re.finditer(f"[A-Za-z0-9+/_.=-]{{{secrets.MIN_TOKEN},}}", text) if not any(a < m.end() and m.start() < b for a, b in spans)]


def test_tokens_that_overlap_no_rule(spark):
    r = random.Random(13)
    pieces = ["password=", "secret: '", "token = ", "my_api_key:", "AKIA" + "X" * 14, "ab12" * 9, "a" * 15, "some_long_name_here", "x", " ", "'", "\n", "=", "é", "0" * 40]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 25))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = secrets._free(secrets._located(secrets._base(df, "doc_id", "text"), "markov", f"[A-Za-z0-9+/_.=-]{{{secrets.MIN_TOKEN},}}"), "markov").collect()
    assert len(rows) == 300
    for row in rows:
        spans = [(s["start"], s["end"]) for name, *_ in secrets.RULES for s in row[name]]
        assert [(s["start"], s["end"]) for s in row["markov"]] == _runs(row["t"], spans)


def test_long_texts_in_linear_time(spark, ratios):
    def took(n):
        text = " ".join(f"password=k{i:07d}abcdef some_long_identifier_{i}" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id int, text string")
        began = time.time()
        row = secrets.scan(df, ratios).select(F.size(F.filter("spans", lambda s: s["kind"] == 0))).first()
        assert row[0] == n
        return time.time() - began

    took(100)
    assert took(16_000) < 3 * took(8_000) + 2


TEXTS = {
    "ru": "В начале лета дети поехали к бабушке в деревню, где было тихо и спокойно. Утром они ходили на речку, днём помогали в саду, а вечером слушали старые истории у печки. ",
    "el": "Το καλοκαίρι τα παιδιά πήγαν στο χωριό της γιαγιάς τους, όπου όλα ήταν ήσυχα. Το πρωί πήγαιναν στο ποτάμι και το βράδυ άκουγαν παλιές ιστορίες δίπλα στη φωτιά μαζί. ",
    "zh": "夏天 孩子 们 去 了 奶奶 的 村子 里 那里 很 安静 早上 他们 去 河边 玩 中午 在 花园 里 帮忙 晚上 坐 在 火炉 旁 听 老 故事 大家 都 很 高兴 。 ",
    "ar": "في الصيف ذهب الأطفال إلى قرية جدتهم حيث كان كل شيء هادئا. في الصباح كانوا يذهبون إلى النهر وفي المساء يستمعون إلى قصص قديمة بجانب النار مع الجيران والأصدقاء. ",
}


def test_other_scripts_are_kept(spark):
    df = spark.createDataFrame(list(TEXTS.items()) + [("junk", "xqz wvk jjr ppd lmn qqr zzt bbv ccx dfg hjk lpw " * 3), ("long", "Donaudampfschifffahrtsgesellschaft " * 40)], "doc_id string, text string")
    got = {r["doc_id"]: (r["kept"], r["failed"]) for r in quality.judged(df).collect()}
    assert all(got[k][0] for k in TEXTS), got
    assert got["junk"][1] == ["stop_word_ratio"] and "mean_word_length" in got["long"][1]
