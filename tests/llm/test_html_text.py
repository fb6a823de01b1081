import pytest
from pyspark.sql import functions as F

from wareloom.llm.html_text import extract_pages, main_text

P1 = "The quick brown fox is in the garden and it was there for a long time with the others of its kind."
P2 = "It was the end of the day and all of the people in the town were on their way to the old market."

PAGES = {
    "plain article": (
        f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><a href=/>Home</a></nav>"
        f"<div class=ad>The best of the offers is for you and it is on sale in the shop at the corner.</div>"
        f"<article><h1>Head</h1><p><b>{P1}<br><p>So it is.</p><p>{P2}</p></article><footer>&copy; {P1}</footer></body></html>",
        f"Head\n\n{P1}\n\nSo it is.\n\n{P2}",
    ),
    "no article element": (
        f"<body><div id=header><a href=/>Home</a> <a href=/x>About us</a></div><h2>Head</h2><p>{P1}</p><p>Yes.</p><p>{P2}</p>"
        f"<div class=sidebar><p>{P2}</p></div><ul class='related'><li><a href=1>{P1}</a></li></ul></body>",
        f"Head\n\n{P1}\n\nYes.\n\n{P2}",
    ),
    "comments, forms and notices inside": (
        f"<main><p>{P1}</p><aside>{P2}</aside><form><p>{P2}</p><input><button>Send the form to us</button></form>"
        f"<div class='cookie-notice'>{P2}</div><p>{P2}</p><section id=comments><h3>2 comments</h3><article class=comment><p>{P1}</p></article></section></main>",
        f"{P1}\n\n{P2}",
    ),
    "references and white space": (
        f"<article><p>A &amp;  B&nbsp;&lt;c&gt; &#233;\n\t{P1}</p></article>",
        f"A & B <c> é {P1}",
    ),
    "links decide": (
        f"<body><p>{P1}</p><p><a href=1>{P2}</a></p><p>{P2} <a href=2>more</a></p></body>",
        f"{P1}\n\n{P2} more",
    ),
    "header of the article": (
        f"<body><header><p>{P2}</p></header><article><header><h1>Head</h1></header><p>{P1}</p></article></body>",
        f"Head\n\n{P1}",
    ),
    "nothing": ("<html><body><nav>a</nav></body></html>", ""),
    "unclosed": (f"<article><p>{P1}<div class=ad>{P2}", P1),
    "short only": ("<article><p>Hi.</p></article>", "Hi."),
    "head without an end": (f"<html><head><title>T</title><meta charset=x><body><p>{P1}</p></body></html>", P1),
    "anchor without a target": (f"<body><a name=top><p>{P1}</p><p>{P2}</p></body>", f"{P1}\n\n{P2}"),
    "link without an end": (f"<body><p>{P1} <a href=1>more<p>{P2}</p></body>", f"{P1} more\n\n{P2}"),
    "page in a form": (
        f"<body><form id=aspnetForm><input name=q><nav><a href=/>Home</a></nav><p>{P1}</p><div class=ad>{P2}</div><p>{P2}</p></form></body>",
        f"{P1}\n\n{P2}",
    ),
    "page in a named wrapper": (f"<body><div id=content-widget><h2>Head</h2><p>{P1}</p><p>{P2}</p></div><footer>{P1}</footer></body>", f"Head\n\n{P1}\n\n{P2}"),
    "comments alone": (f"<body><nav>a</nav><div id=comments><p>{P1}</p><p>{P2}</p></div></body>", ""),
    "items and cells without ends": (
        f"<article><ul><li class=ad>{P2}<li>{P1}</ul><table><tr><td class=promo>{P2}<td>{P1}<tr><td>{P2}</table></article>",
        f"{P1}\n\n{P1}\n\n{P2}",
    ),
    "comment markup": (f"<article><!-- <p>no</p> --><p>{P1}</p></article>", P1),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    html, want = PAGES[name]
    assert main_text(html) == want


def test_odd_pages():
    assert main_text(None) == main_text("") == ""
    assert main_text("just text, no markup") == "just text, no markup"
    assert main_text("<" * 1000) is not None and main_text("<div>" * 3000 + "x") is not None
    assert main_text("<article>" + f"<p>{P1}</p>" * 3000 + "</article>") == "\n\n".join([P1] * 3000)


def test_table(spark):
    rows = [(1, "u", PAGES["short only"][0], "x"), (1, "u", PAGES["short only"][0], "x"), (2, None, None, "x"), (None, "w", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_pages(pages).withColumn("n", F.char_length("text")).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([(1, "u", "Hi.", 3)] * 2 + [(2, None, "", 0), (None, "w", "", 0)], key=str)
    assert extract_pages(pages.limit(0)).count() == 0
