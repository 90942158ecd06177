"""DuckDB SQL with the rows of the queries that SQL can express."""

from __future__ import annotations

#: A period of the schedule is simulated slot by slot, sources without weights as one task; documents are ranked by md5 within their source.
SOURCE_MIX = """
WITH RECURSIVE sized AS (
  SELECT coalesce('s' || source, 'n') AS sk, count(*) AS n FROM documents GROUP BY 1
), src AS (
  SELECT sk, (CASE {cases} ELSE 1 END)::BIGINT AS u, CASE WHEN sk IN ({named}) THEN sk END AS named, row_number() OVER (PARTITION BY sk IN ({named}) ORDER BY md5(sk), sk) - 1 AS i FROM sized
), task AS (
  SELECT named, sum(u)::BIGINT AS u, row_number() OVER (ORDER BY named NULLS LAST) AS i, count(*) AS n FROM src GROUP BY named
), tot AS (SELECT sum(u)::BIGINT AS h FROM task),
sim AS (
  SELECT 0::BIGINT AS t, i, named, u, n, h, 0::BIGINT AS done FROM task, tot
  UNION ALL
  SELECT t + 1, i, named, u, n, h, done + CASE WHEN first = 1 THEN 1 ELSE 0 END
  FROM (SELECT *, row_number() OVER (ORDER BY CASE WHEN (done * h) // u <= t THEN 0 ELSE 1 END, ((done + 1) * h + u - 1) // u, i) AS first FROM sim WHERE t < h)
), slots AS (
  SELECT a.named, a.u, a.n, a.h, a.done AS j, a.t AS slot FROM sim a JOIN sim b ON a.i = b.i AND b.t = a.t + 1 AND b.done > a.done
), ranked AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS sk,
    row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1 AS r FROM documents
), block AS (
  SELECT doc_id, source, r, src.named, CASE WHEN src.named IS NULL THEN (r // {rows}) * (SELECT n FROM task WHERE named IS NULL) + i ELSE r // {rows} END AS g FROM ranked JOIN src ON ranked.sk = src.sk
)
SELECT doc_id, source, ((g // u) * h + slot)::BIGINT AS mix_slot, (r // {rows})::BIGINT AS mix_block, (r % {rows})::BIGINT AS mix_row
FROM block JOIN slots ON block.named IS NOT DISTINCT FROM slots.named AND slots.j = g % u
"""

CHAT_FORMAT = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), k AS (SELECT *, (strlen(text) + 3) // 4 + 4 AS k FROM said),
n AS (
  SELECT *, row_number() OVER w AS pos, sum(k) OVER (w ROWS UNBOUNDED PRECEDING) - k AS p0
  FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sys AS (SELECT conv_id, text AS sys, k AS sk FROM n WHERE pos = 1 AND role = 'system'),
body AS (
  SELECT n.conv_id, role, text, k, pos, p0 - coalesce(sk, 0) AS p,
    (p0 - coalesce(sk, 0))::BIGINT // greatest(1, ({budget} - {history} - coalesce(sk, 0))::BIGINT // 2) AS w
  FROM n LEFT JOIN sys ON n.conv_id = sys.conv_id WHERE NOT (pos = 1 AND role = 'system')
), starts AS (SELECT conv_id, w, min(p) AS start FROM body GROUP BY ALL),
pieces AS (
  SELECT conv_id, 3 AS state, role, text FROM body
  UNION ALL SELECT b.conv_id, 4, role, text FROM body b JOIN starts s ON b.conv_id = s.conv_id AND s.w > b.w AND s.start - b.p <= {history}
  UNION ALL SELECT sys.conv_id, 4, 'system', sys FROM sys JOIN starts s ON s.conv_id = sys.conv_id WHERE s.w > (SELECT min(x.w) FROM starts x WHERE x.conv_id = s.conv_id)
  UNION ALL SELECT conv_id, 3, 'system', sys FROM sys
), chars AS (
  SELECT conv_id, sum(state + 16 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')))::BIGINT AS formatted_chars
  FROM pieces GROUP BY conv_id
), turns AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss
  FROM said GROUP BY conv_id
)
SELECT turns.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM turns JOIN chars ON turns.conv_id = chars.conv_id
"""

SHARDING = "SELECT doc_id, strlen(text)::BIGINT AS n_bytes, md5(text) AS text_md5 FROM documents"
