"""The registered queries in plain SQL, straight from the test tables."""

from __future__ import annotations

FEED = """
WITH feed AS (SELECT event_id AS "offset", CAST(user_id % 4 AS INTEGER) AS "partition",
  'srv.db.dbo.Emp' || CAST(user_id % 3 AS VARCHAR) AS topic,
  user_id AS "ID", event_type AS "Label", value AS "Amount",
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS "Note",
  CASE WHEN event_type = 'signup' THEN 'create' WHEN event_type <> 'error' THEN 'update'
       WHEN event_id % 4 = 0 THEN 'delete' WHEN event_id % 8 = 7 THEN 'bad_key'
       WHEN event_id % 8 = 3 THEN 'bad_value' ELSE 'invalid_op' END AS action FROM events),
net AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY "offset" DESC) AS rn
  FROM feed WHERE action IN ('create','update','delete')) WHERE rn = 1),
base AS (SELECT 2 * c_custkey AS "ID", c_mktsegment AS "Label", c_acctbal AS "Amount",
  c_name AS "Note" FROM customer)
"""

MERGED = """
SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM net n WHERE n."ID" = b."ID")
UNION ALL SELECT "ID","Label","Amount","Note" FROM net WHERE action <> 'delete'
"""

ORACLES: dict[str, str] = {
    "decode_feed": FEED + """SELECT "offset","ID","Label","Amount","Note" FROM feed
        WHERE action IN ('create','update')""",
    "decode_rows": FEED + """SELECT "ID","Label","Amount","Note" FROM feed
        WHERE action IN ('create','update')""",
    "classify_actions": FEED + "SELECT topic, action, count(*) AS n FROM feed GROUP BY ALL",
    "feed_audit": FEED + """SELECT topic,"partition",action,count(*) AS n,min("offset") AS lo,
        max("offset") AS hi FROM feed GROUP BY ALL""",
    "rejects": FEED + """SELECT topic,"partition","offset",action FROM feed
        WHERE action IN ('bad_key','bad_value','invalid_op')""",
    "topic_filter": FEED + """SELECT topic, count(*) AS n FROM feed
        WHERE topic IN ('srv.db.dbo.Emp0','srv.db.dbo.Emp2') GROUP BY 1""",
    "topic_pattern": FEED + r"""SELECT topic, count(*) AS n FROM feed
        WHERE regexp_matches(topic, '^srv\..*Emp[01]$') GROUP BY 1""",
    "route_topics": FEED + """SELECT lower(replace(topic,'.','_')) AS table_name,
        count(DISTINCT "ID") AS k FROM feed WHERE action IN ('create','update') GROUP BY 1""",
    "route_constant": FEED + "SELECT 'current' AS table_name, count(*) AS n FROM feed",
    "route_map": FEED + """SELECT CASE WHEN topic = 'srv.db.dbo.Emp2' THEN 'srv_db_dbo_emp2'
        ELSE 'staff' END AS table_name, count(*) AS n FROM feed GROUP BY 1""",
    "key_columns": FEED + """SELECT topic, 'ID' AS c, count(*) AS n FROM feed
        WHERE action <> 'bad_key' GROUP BY 1""",
    "explode_entries": FEED + """SELECT k, count(*) AS n, count(v) AS nv FROM (
        SELECT unnest(['ID','Label','Amount','Note']) AS k,
        unnest([CAST("ID" AS VARCHAR),"Label",CAST("Amount" AS VARCHAR),"Note"]) AS v
        FROM feed WHERE action='update') GROUP BY 1""",
    "drift_check": "SELECT event_id % 7 <> 0 AS ok, count(*) AS n FROM events GROUP BY 1",
    "connect_schema": FEED + """, carried AS (SELECT topic, "offset" // 700 % 3 AS version, count(*) AS n FROM feed
          WHERE action NOT IN ('delete', 'bad_value') GROUP BY 1, 2)
        SELECT topic, place, c, type, n FROM carried JOIN
        (VALUES (0,0,'ID','bigint'), (0,1,'Label','string'), (0,2,'Amount','double'), (0,3,'Note','string'),
          (1,0,'ID','bigint'), (1,1,'Label','string'), (1,2,'Amount','double'), (1,3,'Note','string'),
          (2,0,'ID','int'), (2,1,'Label','string'), (2,2,'Amount','double')) AS listed(version, place, c, type)
        USING (version)""",
    "schema_history": FEED + """, carried AS (SELECT topic, "partition", "offset", "offset" // 700 % 3 AS version
          FROM feed WHERE action NOT IN ('delete', 'bad_value')),
        marked AS (SELECT *, CASE WHEN version = lag(version) OVER w THEN 0 ELSE 1 END AS new FROM carried
          WINDOW w AS (PARTITION BY topic, "partition" ORDER BY "offset")),
        numbered AS (SELECT *, sum(new) OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS run FROM marked)
        SELECT topic, "partition", min("offset") AS first, max("offset") AS last, count(*) AS n,
          CASE min(version) WHEN 2 THEN 'ID int, Label string, Amount double'
            ELSE 'ID bigint, Label string, Amount double, Note string' END AS columns
        FROM numbered GROUP BY topic, "partition", run""",
    "enum_check": FEED + """SELECT topic, "partition", "offset", 'Label' AS c, "Label" AS value FROM feed
        WHERE action IN ('create', 'update') AND "offset" // 700 % 3 = 1
        AND "Label" NOT IN ('click', 'purchase', 'signup')""",
    "allowed_actions": FEED + """SELECT topic, CASE WHEN action IN ('create', 'update') AND "offset" // 700 % 3 = 1
          AND "Label" NOT IN ('click', 'purchase', 'signup') THEN 'not_allowed' ELSE action END AS action,
        count(*) AS n FROM feed GROUP BY ALL""",
    "inferred_schema": FEED + """, images AS (SELECT topic, count(*) AS n,
          bool_or("offset" % 2 = 0) AS whole, bool_or("offset" % 2 = 1) AS half,
          max(length(CAST(CAST(floor(abs("Amount")) AS BIGINT) AS VARCHAR))) AS digits,
          bool_or("offset" % 3 = 0) AS numbers, bool_or("offset" % 3 <> 0) AS texts
          FROM feed WHERE action IN ('create', 'update') GROUP BY 1),
        sold AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 2 <> 0) AS none,
          bool_or(o_orderkey % 4 = 0) AS whole, bool_or(o_orderkey % 4 <> 0) AS part FROM orders)
        SELECT topic, c, n, CASE c WHEN 'Gone' THEN n ELSE 0 END AS nulls, CASE c WHEN 'ID' THEN 'BIGINT'
            WHEN 'Label' THEN 'STRING' WHEN 'Gone' THEN 'VOID' WHEN 'Tags' THEN 'ARRAY<BIGINT>'
            WHEN 'Part' THEN 'OBJECT<Code: STRING, Size: BIGINT>'
            WHEN 'Amount' THEN CASE WHEN whole AND half THEN 'DECIMAL(21,1)' WHEN whole THEN 'BIGINT'
              ELSE 'DECIMAL(' || (digits + 1) || ',1)' END
            ELSE CASE WHEN numbers AND texts THEN 'VARIANT' WHEN numbers THEN 'BIGINT' ELSE 'STRING' END END AS type
        FROM images, (VALUES ('ID'), ('Label'), ('Amount'), ('Note'), ('Gone'), ('Tags'), ('Part')) AS listed(c)
        UNION ALL SELECT 'srv.db.dbo.Order', c, n, CASE c WHEN 'Cust' THEN none ELSE 0 END,
          CASE c WHEN 'Key' THEN 'BIGINT' WHEN 'Open' THEN 'BOOLEAN'
            WHEN 'Cust' THEN CASE WHEN none < n THEN 'BIGINT' ELSE 'VOID' END
            ELSE CASE WHEN whole AND part THEN 'ARRAY<DECIMAL(22,2)>' WHEN whole THEN 'ARRAY<BIGINT>'
              ELSE 'ARRAY<DECIMAL(2,2)>' END END
        FROM sold, (VALUES ('Key'), ('Open'), ('Cust'), ('Lines')) AS listed(c)""",
    "offset_gaps": """WITH kept AS (SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset"
          FROM events WHERE NOT (event_id % 89 < 9 OR event_id // 512 % 5 = 3)),
        followed AS (SELECT "partition", "offset", lead("offset") OVER (PARTITION BY "partition" ORDER BY "offset") AS after
          FROM kept)
        SELECT 'srv.db.dbo.Emp' AS topic, "partition", "offset" + 1 AS first, after - 1 AS last, after - "offset" - 1 AS n
        FROM followed WHERE after > "offset" + 1""",
    "overwrite_then_feed": FEED.replace("('create','update','delete')) WHERE rn = 1", """('create','update','delete')
          AND "offset" >= (SELECT max(event_id) // 2 FROM events)) WHERE rn = 1""") + MERGED,
    "last_per_key": FEED + """SELECT "ID","offset",action FROM net""",
    "state_after_feed": FEED + """SELECT "ID","Label","Amount","Note" FROM net
        WHERE action <> 'delete'""",
    "upsert_merge": FEED + MERGED,
    "delete_by_key": FEED + """SELECT * FROM base b WHERE NOT EXISTS
        (SELECT 1 FROM feed f WHERE f.action='delete' AND f."ID"=b."ID")""",
    "merge_composite_key": FEED + """, pair AS (SELECT * FROM (SELECT *, row_number() OVER
          (PARTITION BY "ID","Label" ORDER BY "offset" DESC) AS pn
          FROM feed WHERE action IN ('create','update','delete')) WHERE pn = 1),
        target AS (SELECT 2 * c_custkey AS "ID",
          CASE c_nationkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
            WHEN 3 THEN 'signup' ELSE 'view' END AS "Label",
          c_acctbal AS "Amount", c_name AS "Note" FROM customer)
        SELECT * FROM target t WHERE NOT EXISTS
          (SELECT 1 FROM pair p WHERE p."ID"=t."ID" AND p."Label"=t."Label")
        UNION ALL SELECT "ID","Label","Amount","Note" FROM pair WHERE action <> 'delete'""",
    # a deleted key loses all its rows; if it comes back, it is one row
    "merge_multi_match": FEED + """, target AS (SELECT 2 * o_custkey AS "ID",
          o_orderpriority AS "Label", o_totalprice AS "Amount", o_orderstatus AS "Note" FROM orders),
        gone AS (SELECT DISTINCT "ID" FROM feed WHERE action = 'delete'),
        left_over AS (SELECT * FROM target t WHERE NOT EXISTS
          (SELECT 1 FROM gone g WHERE g."ID"=t."ID"))
        SELECT * FROM left_over t WHERE NOT EXISTS (SELECT 1 FROM net n WHERE n."ID"=t."ID")
        UNION ALL SELECT n."ID",n."Label",n."Amount",n."Note" FROM left_over t
          JOIN net n ON n."ID"=t."ID"
        UNION ALL SELECT "ID","Label","Amount","Note" FROM net n WHERE action <> 'delete'
          AND NOT EXISTS (SELECT 1 FROM left_over t WHERE n."ID"=t."ID")""",
    "merge_null_key": FEED + """, known AS (SELECT * FROM (SELECT *, row_number() OVER
          (PARTITION BY "ID" ORDER BY "offset" DESC) AS kn
          FROM feed WHERE action IN ('update','delete')) WHERE kn = 1)
        SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k."ID"=b."ID")
        UNION ALL SELECT "ID","Label","Amount","Note" FROM known WHERE action = 'update'
        UNION ALL SELECT NULL,"Label","Amount","Note" FROM feed WHERE action = 'create'""",
    "append_log": FEED + """SELECT * FROM base UNION ALL
        SELECT "ID","Label","Amount","Note" FROM feed WHERE action IN ('create','update')""",
    "keyed_update": FEED + """SELECT "ID","Label","Amount",
        CASE WHEN "Label"='BUILDING' THEN 'hold' ELSE "Note" END AS "Note" FROM base""",
    "keyed_update_overwrite": FEED + """SELECT "ID","Label","Amount",'hold' AS "Note" FROM base
        WHERE "Label"='BUILDING'""",
    "filter_by_conditions": """SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice
        FROM lineitem WHERE l_linenumber = 3 AND l_returnflag = 'A'""",
    "preview": FEED + f"""SELECT * FROM ({MERGED}) ORDER BY "ID" LIMIT 20""",
    "scan_table": FEED + "SELECT * FROM base",
    "stored_update": FEED + f"""SELECT "ID","Label","Amount",
        CASE WHEN "Label"='view' THEN 'hold' ELSE "Note" END AS "Note" FROM ({MERGED})""",
    "stored_delete": FEED + f"""SELECT * FROM ({MERGED}) WHERE "Label" <> 'view'""",
    "typed_rows": """SELECT o_orderkey AS "ID", CAST(o_custkey AS INTEGER) AS "Cust",
        CAST(o_totalprice AS DECIMAL(12,2)) AS "Price", o_orderstatus = 'O' AS "Open",
        date_trunc('day', o_orderdate) AS "Placed", strftime(o_orderdate, '%Y-%m-%d') AS "Due",
        o_orderpriority AS "Code", CAST((o_orderkey % 100) / 10.0 AS DECIMAL(6,1)) AS "Weight" FROM orders
        WHERE o_orderkey % 20 NOT IN (3, 7, 11, 13, 15, 17, 19)""",
    "typed_actions": """SELECT 'srv.db.dbo.Order' AS topic,
        CASE o_orderkey % 20 WHEN 7 THEN 'bad_key' WHEN 3 THEN 'bad_value' WHEN 11 THEN 'bad_value'
          WHEN 13 THEN 'bad_value' WHEN 15 THEN 'bad_value' WHEN 17 THEN 'bad_value'
          WHEN 19 THEN 'bad_value' ELSE 'create' END AS action, count(*) AS n
        FROM orders GROUP BY ALL""",
    "moved_keys_rejected": FEED + """, moved AS (SELECT "ID", "offset" // 4 AS o,
          CAST("offset" % 4 AS INTEGER) AS p, 'srv.db.dbo.Emp' || CAST("offset" % 3 AS VARCHAR) AS t
          FROM feed WHERE action IN ('create','update','delete')),
        placed AS (SELECT "ID", t, p, max(o) AS o FROM moved GROUP BY 1, 2, 3),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY t DESC, p DESC) AS home
          FROM placed)
        SELECT t AS topic, p AS "partition", o AS "offset" FROM ranked WHERE home > 1""",
    "stream_dedup": FEED + """, sent AS (SELECT "offset", action FROM feed
          UNION ALL SELECT "offset", 'invalid_op' FROM feed WHERE action = 'delete')
        SELECT 'srv.db.dbo.Emp' || CAST("offset" % 3 AS VARCHAR) AS topic, action, count(*) AS n FROM sent GROUP BY ALL""",
    "stream_progress": FEED + """SELECT 'current' AS table_name,
        count(*) FILTER (action = 'create') AS "create", count(*) FILTER (action = 'update') AS "update",
        count(*) FILTER (action = 'delete') AS "delete", count(*) FILTER (action = 'bad_key') AS bad_key,
        count(*) FILTER (action = 'bad_value') AS bad_value, count(*) FILTER (action = 'invalid_op') AS invalid_op,
        CAST(0 AS BIGINT) AS drift, CAST(0 AS BIGINT) AS not_allowed, min("offset") AS lo, max("offset") AS hi FROM feed""",
    "many_tables": FEED + """SELECT 'srv_db_dbo_t' || CAST("ID" % 50 AS VARCHAR) AS table_name,
        "ID", "Label", "Amount", "Note" FROM net WHERE action <> 'delete'""",
    "route_one_table": FEED + """SELECT 'srv_db_dbo_emp0' AS table_name, count(*) AS n FROM net
        WHERE topic = 'srv.db.dbo.Emp0' AND action <> 'delete'
        UNION ALL SELECT 'unrouted', count(*) FROM feed WHERE topic <> 'srv.db.dbo.Emp0'""",
    "apply_stream_routed": FEED + """, topics AS (SELECT DISTINCT topic FROM feed)
        SELECT lower(replace(t.topic,'.','_')) AS table_name, count(n."ID") AS n
        FROM topics t LEFT JOIN net n ON n.topic = t.topic AND n.action <> 'delete'
        WHERE t.topic <> 'srv.db.dbo.Emp2' GROUP BY 1
        UNION ALL SELECT 'unrouted', count(*) FROM feed WHERE topic = 'srv.db.dbo.Emp2'""",
}
ORACLES["overwrite_table"] = ORACLES["scan_table"]
ORACLES["append_table"] = ORACLES["append_log"]
ORACLES["redriven_rejects"] = ORACLES["state_after_feed"]
ORACLES["commit_order"] = ORACLES["upsert_merge"]
ORACLES["apply_stream"] = ORACLES["upsert_merge"]
ORACLES["bucketed_table"] = ORACLES["upsert_merge"]
ORACLES["compacted_table"] = ORACLES["upsert_merge"]
ORACLES["replay"] = ORACLES["upsert_merge"]
ORACLES["apply_stream_rejects"] = ORACLES["rejects"]
ORACLES["moved_keys"] = ORACLES["upsert_merge"]
ORACLES["merge_multi_match_compacted"] = ORACLES["merge_multi_match"]
ORACLES["replay_rejects"] = ORACLES["rejects"]
