"""Schemas of the tables that stages hand to each other, as DDL."""

DOCUMENTS = "doc_name string, ticker string, year int, scope string, path string, text string"
TABLES = (
    "doc_name string, ticker string, year int, scope string, line int, order int, table_ref string, page int, context_before string, "
    "closed boolean, html string, grid array<array<string>>, header array<string>, rows array<array<string>>"
)
TABLE_INDEX = (
    "table_ref string, doc_name string, ticker string, year int, scope string, line int, order int, page int, n_rows int, n_cols int, index_text string"
)
QUESTIONS = "id int, question string"
CANDIDATE = (
    "table_ref string, doc_name string, ticker string, year int, scope string, line int, page int, rank int, score double, context_before string, csv_text string"
)
RETRIEVAL = f"id int, question string, tickers array<string>, years array<int>, scope string, candidates array<struct<{CANDIDATE.replace(' ', ':').replace(',:', ',')}>>"
EVIDENCE = "array<struct<variable:string,csv_path:string>>"
PREDICTIONS = (
    f"id int, pandas_query string, answer double, evidence {EVIDENCE}, used_table_refs array<string>, exec_ok boolean, exec_error string, raw_completion string"
)
SUBMISSION = (
    f"id int, question string, answer double, relevant_docs array<string>, relevant_tables array<string>, evidence {EVIDENCE}, pandas_query string"
)
