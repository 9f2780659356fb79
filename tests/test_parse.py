"""Skeleton text to blocks: one case for each line form and for what blocks inherit."""

import pytest

from blockloom.operators.parse import parse

MIXED = """<!-- meta:page_start page=2 -->
# Guide
- one
- two

3. three
Plain text with $x$ inside
$$a=b$$
<!-- IMAGE: pic.png zone=body -->

[VISION_PLACEHOLDER_pic.png]
| caption row
| h1 | h2 |
| --- | --- |
| a | b |
<!-- meta:zone footer -->
foot
<!-- meta:zone_end -->
### Deep
> [图表: bars]
```python
# not a heading

x | y
```
## Next
H z =
b0 + b1z−1

1 + a1z−1 (2)
tail"""


def rows(spark, text, fmt=".pdf"):
    docs = spark.createDataFrame([("d", "source/f" + fmt, fmt, text)], "doc_id string, source_file string, fmt string, text string")
    return parse(docs).orderBy("ord").collect()


@pytest.fixture(scope="module")
def mixed(spark):
    return rows(spark, MIXED)


def test_types_and_ids(mixed):
    assert [r.type for r in mixed] == ["heading", "list", "list", "para", "formula", "figure", "table", "para", "heading", "para", "code", "heading", "formula", "para"]
    assert [r.id for r in mixed][:3] == ["block_heading_001", "block_list_001", "block_list_002"]
    assert [r.ord for r in mixed] == list(range(1, 15))


def test_payloads(mixed):
    assert mixed[1].content["items"] == ["one", "two"] and not mixed[1].content.ordered
    assert mixed[2].content.ordered
    assert mixed[4].formula.latex == "a=b" and mixed[4].confidence == 0.9 and mixed[4].needs_review
    assert mixed[5].figure.asset_id == "asset_pic" and mixed[5].figure.asset_file == "extracted/images/pic.png" and mixed[5].source_zone == "body"
    t = mixed[6]
    assert t.title == "caption row" and t.table.columns == ["h1", "h2"] and [[c.text for c in r] for r in t.table.rows] == [["a", "b"]] and t.needs_review
    assert mixed[7].source_zone == "footer" and mixed[8].source_zone is None
    assert mixed[9].content.placeholder_type == "图表" and mixed[9].content.quote
    assert mixed[10].code.language == "python" and mixed[10].code.text == "# not a heading\n\nx | y"
    f = mixed[12].formula
    assert f.equation_no == "2" and f.latex == r"H(z)=\frac{b_{0} + b_{1}z^{-1}}{1 + a_{1}z^{-1}}"
    assert mixed[13].content.text == "tail"


def test_anchor_of_each_format(spark):
    text = "# A\n### B\n## C\nx"
    a = {f: rows(spark, text, f)[-1].source_anchor for f in (".pdf", ".docx", ".md", ".pptx", ".xlsx")}
    assert a[".md"].heading_path == ["A", "C"] and a[".md"].block_index == 4 and a[".md"].kind == "text_anchor"
    assert a[".docx"].paragraph_index == 4 and "page" in a[".docx"]["keys"]
    assert a[".pdf"].page is None and "page" in a[".pdf"]["keys"]
    slide = rows(spark, "## Slide 2: Intro\ntext\n## Sheet: S1\ny", ".pptx")
    assert slide[1].source_anchor.slide == 2
    assert rows(spark, "## Sheet: S1\ny", ".xlsx")[1].source_anchor.sheet == "S1"


@pytest.mark.parametrize(
    "text,types",
    [
        ("", []),
        ("\n\n  \n", []),
        ("a = b\n# H\n(2)", ["para", "heading", "para"]),
        ("| no | separator", ["para"]),
        ("| --- |\n| a |", ["table"]),
        ("<!-- IMAGE: p.png page_render=true -->\n[VISION_PLACEHOLDER_p.png]", []),
        ("[VISION_PLACEHOLDER_q.png]", ["figure"]),
        ("```\nopen", ["code"]),
        ("H z = 1\n# stop\n(3)", ["para", "heading", "para"]),
        ("<!-- note -->\ntext", ["para"]),
    ],
)
def test_small_cases(spark, text, types):
    assert [r.type for r in rows(spark, text)] == types


def test_malformed_table(spark):
    t = rows(spark, "| --- | --- |\n| a | b |\n| c |")[0]
    assert t.needs_review and t.table.hard_column_check == "fail"
    assert rows(spark, "||a|\n|---|\n|x|")[0].table.columns == ["a"]
