"""Pages unlike the test tables: odd letters, and frame-like names on wrappers."""

import pytest

from postsift.llm import html_text

NONE = html_text.learn_weights([])


def test_text_after_a_script_behind_dotted_capital_i():
    for name in html_text.RAW:
        page = f"<div><p>\u0130stanbul \u0130zmir</p><{name}>x</{name.upper()}><p>rest of it</p></div>"
        assert html_text.main_text(page, NONE) == "\u0130stanbul \u0130zmir rest of it"


TEXT = " ".join(f"<p>Paragraph {i} of the story has words of its own.</p>" for i in range(12))
WANT = " ".join(f"Paragraph {i} of the story has words of its own." for i in range(12))
FRAME = "<div class='menu'>Home News</div>"


@pytest.mark.parametrize("page", [
    f"<body class='has-sidebar'>{FRAME}<div>{TEXT}</div></body>",
    f"<body class='comments-open'>{FRAME}{TEXT}</body>",
    f"<body>{FRAME}<div class='content with-sidebar'>{TEXT}<div class='share'>Share this now</div></div></body>",
    f"<body><form id='form1'>{FRAME}<div>{TEXT}</div></form></body>",
    f"<body><form><div class='page search'>{FRAME}<div>{TEXT}</div></div></form></body>",
    f"<body><div class='sidebar-left'><article>{TEXT}</article>{FRAME}</div><div>{'<p>more plain words here</p>' * 8}</div></body>"
    .replace("<div><p>more", "<div class='related'><p>more"),
])
def test_frame_names_on_wrappers(page):
    assert html_text.main_text(page, NONE) == WANT


def test_frames_inside_stay_out():
    comments = "<p>I have much more to say than the story itself.</p>" * 30
    for frame in (f"<div class='comments'>{comments}</div>", f"<nav>{comments}</nav>", f"<footer><div>{comments}</div></footer>",
                  "<aside class='related'><article><p>A teaser of another story.</p></article></aside>"):
        assert html_text.main_text(f"<body><div>{TEXT}</div>{frame}</body>", NONE) == WANT


def test_learnt_evidence_goes_before_a_name():
    labelled = ["<div class='rail'><article><p>" + "word " * 50 + "</p></article></div><div class='x'>menu words</div>"] * 5
    page = f"<div class='rail'>{TEXT}</div>" + f"<div>{'<p>plain words</p>' * 20}</div>"
    assert html_text.main_text(page, html_text.learn_weights(labelled)).startswith(WANT)
