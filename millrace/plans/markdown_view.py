"""A Markdown view of ``documents``, the same in Spark and in ANSI SQL engines.

The plain texts have no headings, fences, links or tags; the view adds them by the id's
remainders, so that every text operator has something to do. Whole texts are kept.
"""

from __future__ import annotations

NL = "chr(10)"
GAP = "chr(10) || chr(10)"


def markdown_sql(table: str = "documents", backreference: str = "$1", flags: str = "") -> str:
    """SELECT of pos, document_id, text, source, category, framework, url.

    ``backreference`` and ``flags`` are what the engine's regexp_replace wants.
    """
    paragraphs = lambda x: f"regexp_replace({x}, '((?:[^ ]+ ){{40}})', '{backreference}' || {GAP}{flags})"
    return f"""
SELECT doc_id AS pos, 'doc_' || CAST(doc_id AS varchar(20)) AS document_id,
  '# Title ' || CAST(doc_id AS varchar(20)) || {GAP} || substr(text, 1, 400) || {GAP} ||
  (CASE doc_id % 3 WHEN 0 THEN '## How to use tool ' || CAST(doc_id AS varchar(20)) WHEN 1 THEN '## Alpha vs Beta' ELSE '## System design notes' END) || {GAP} ||
  {paragraphs("substr(text, 401, 4000)")} || {GAP} ||
  (CASE doc_id % 5
    WHEN 0 THEN '```python' || {NL} || '# setup step' || {NL} || 'import os' || {NL} || 'value = os.environ.get("KEY", "default")' || {NL} || '```'
    WHEN 1 THEN '```sql' || {NL} || 'SELECT a, count(*) FROM t GROUP BY a' || {NL} || '```'
    WHEN 2 THEN '```' || {NL} || '  const total = items.length;' || {NL} || '  <tag>padded</tag>' || {NL} || '```'
    WHEN 3 THEN '```c++' || {NL} || 'int main() {{ return 0; }}' || {NL} || '```' ELSE '' END) || {GAP} ||
  (CASE doc_id % 7
    WHEN 0 THEN 'We use cookies to improve this site'
    WHEN 1 THEN 'See [the guide](https://example.org/guide) and [x]() or [y](#).'
    WHEN 2 THEN 'A &amp;lt; B &copy; and <b>bold</b> text'
    WHEN 3 THEN 'Licensed under the Apache license, as is.'
    WHEN 4 THEN '*****' || {GAP} || '• first' || {NL} || '‣ second'
    WHEN 5 THEN 'You should note that steps: first,then it works because the system fails with an error.'
    ELSE 'Copyright 2020 someone' END) || {GAP} ||
  '### Details' || {GAP} || {paragraphs("substr(text, 4401)")} AS text,
  CASE doc_id % 5 WHEN 0 THEN 'github' WHEN 1 THEN 'documentation' WHEN 2 THEN 'huggingface' WHEN 3 THEN 'blog' ELSE 'paper' END AS source,
  CASE doc_id % 4 WHEN 0 THEN 'agent_engineering' WHEN 1 THEN 'llm_engineering' WHEN 2 THEN 'data_science' ELSE 'uncategorized' END AS category,
  CASE doc_id % 3 WHEN 0 THEN 'spark' WHEN 1 THEN '' ELSE NULL END AS framework,
  'https://example.org/' || CAST(doc_id AS varchar(20)) AS url
FROM {table}"""
