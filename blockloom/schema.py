"""The block table and the tables around it, as DDL.

A document is a set of rows of ``blocks``: ``(doc_id, ord)`` is the key, ``ord`` the order in the document.  All other
tables are projections of it or inputs to it.
"""

from __future__ import annotations

ANCHOR = "struct<kind:string,source_file:string,page:int,page_label:string,slide:int,sheet:string,range:string,heading_path:array<string>,paragraph_index:int,block_index:int,keys:array<string>>"
HEADING = "struct<level:int,text:string,raw_level:int>"
CONTENT = "struct<text:string,quote:boolean,placeholder_type:string,likely_noise:boolean,is_caption_for:string,items:array<string>,ordered:boolean>"
CELL = "struct<text:string,rowspan:int,colspan:int>"
TABLE = f"struct<columns:array<string>,header_rows:array<int>,rows:array<array<{CELL}>>,continues_from:string,continues_to:string,hard_column_check:string,hard_table_type:string>"
FIGURE = "struct<figure_no:string,caption:string,asset_id:string,asset_file:string,original_asset_file:string,description:string,estimated_values:array<struct<label:string,value:string,basis:string>>,likely_noise:boolean,noise_reason:string>"
FORMULA = "struct<equation_no:string,latex:string,plain_text_source:string,visual_check:string,control_source:string>"
CODE = "struct<language:string,text:string>"
PAYLOADS = {"heading": HEADING, "content": CONTENT, "table": TABLE, "figure": FIGURE, "formula": FORMULA, "code": CODE}
BLOCKS = (
    f"doc_id string, ord int, id string, type string, source_anchor {ANCHOR}, confidence double, needs_review boolean, source_zone string, title string, "
    + ", ".join(f"{k} {v}" for k, v in PAYLOADS.items())
)
ISSUES = "doc_id string, id string, severity string, status string, accepted_by string, accepted_reason string, source_block_id string, source_anchor string, category string, issue string, required_action string, found_by string, created_at string"
CHECKS = "doc_id string, gate string, phase string, id string, ok boolean, level string, message string"
SNAPSHOT = "doc_id string, phase string, kind string, path string, sha256 string, bytes long"

# The vocabulary of the tables.
PAYLOAD_OF = {"heading": "heading", "para": "content", "list": "content", "table": "table", "figure": "figure", "formula": "formula", "code": "code"}
ANCHOR_KEYS = {
    "pdf_page": ("source_file", "page"),
    "slide": ("source_file", "slide"),
    "sheet_range": ("source_file", "sheet"),
    "docx_anchor": ("source_file", "heading_path", "paragraph_index"),
    "text_anchor": ("source_file", "heading_path", "block_index"),
}
PHASES = ("0_intake", "1_extraction", "2_ir_build", "3_semantic_compile", "4_audit", "5_assembly", "6_validation", "7_package")
PHASE_STATUS = ("pending", "in_progress", "done", "failed")
RISKS = ("low", "medium", "high")
SEVERITIES = ("blocker", "major", "minor", "info")
ISSUE_STATUS = ("open", "accepted", "fixed")
CATEGORIES = ("ocr", "table", "formula", "figure", "provenance", "source_conflict", "rendering")
