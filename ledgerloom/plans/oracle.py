"""The same results as plain SQL over the base tables, for another engine to check against.

Shared parts are named ``x_*`` and are pulled in as common table expressions where a text uses them.
"""

import re

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.operators.quality import DEFAULT_SPECS, QualitySpec
from ledgerloom.plans import catalog
from ledgerloom.plans import pipeline as stand_in
from ledgerloom.sources.schemas import RAW_TRANSACTION_COLUMNS


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


def _case(column: str, mapping: dict, default: str) -> str:
    arms = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


def _dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _txt(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


M, S = "DECIMAL(19,4)", "DECIMAL(28,8)"
_num = "CAST(CAST(value AS DECIMAL(19,2)) AS VARCHAR)"
_signed = f"CASE WHEN event_id % 3 = 0 THEN '-' || {_num} ELSE {_num} END"
_action = _case("event_type", stand_in.EVENT_ACTIONS, "NULL")
_gbp = "CASE WHEN event_id % 5 = 0 THEN '  ' WHEN event_id % 4 = 0 THEN NULL ELSE ' GBP ' END"
_RAW = {
    "Action": f"CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 29 = 0 THEN upper({_action}) "
              f"ELSE '  ' || {_action} || ' ' END",
    "Transaction Date": "CASE WHEN event_id % 13 = 0 THEN 'not-a-date' WHEN event_id % 17 = 0 THEN NULL "
                        "ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END",
    "Time": "CASE WHEN event_id % 41 = 0 THEN 'xx' WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%H:%M:%S') END",
    "Ticker": "CASE WHEN event_id % 10 = 0 THEN '   ' ELSE 'T' || (user_id % 8) END",
    "Name": "' Name ' || (user_id % 16) || ' '",
    "No. of shares": _signed,
    "Price / share": f"CASE WHEN event_id % 6 = 0 THEN NULL ELSE {_num} END",
    "Currency (Price / share)": _gbp,
    "Exchange rate": f"CASE WHEN event_id % 19 = 0 THEN 'Not available' ELSE {_num} END",
    "Result of Sell": f"CASE WHEN event_id % 9 = 0 THEN {_signed} END",
    "Currency (Result)": _gbp,
    "Total (GBP)": f"CASE WHEN event_id % 19 = 0 THEN 'Not available' WHEN event_id % 23 = 0 THEN 'abc' ELSE {_signed} END",
    "Currency (Total)": _gbp,
    "Withholding tax": f"CASE WHEN event_id % 8 = 0 THEN {_num} END",
    "Notes": f"CASE WHEN event_id % 14 = 0 THEN ' note ' || {_num} END",
    "ID": "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '  ' ELSE 'E' || event_id END",
    "Unnamed: 22": "CASE WHEN event_id % 14 = 0 THEN ' U22-E' || event_id || ' ' END",
    "Unnamed: 23": "CASE WHEN event_id % 33 = 0 THEN 'U23-E' || event_id ELSE '' END",
}
_raw_list = ", ".join(f"CAST({_RAW.get(c, 'NULL')} AS VARCHAR) AS \"{c}\"" for c in RAW_TRANSACTION_COLUMNS)
_names = ", ".join(f'"{c}"' for c in RAW_TRANSACTION_COLUMNS)
_blank = lambda c: f"nullif(trim(\"{c}\"), '')"
_abs = lambda c, k: f'abs(TRY_CAST("{c}" AS {k}))'
_digit = f"break_id % {fixed.STATUS_CYCLE}"
_steps = fixed.STATUS_STEPS
_cycle = lambda i: ("CASE " + " ".join(f"WHEN {_digit} < {s[0]} THEN {_lit(s[i])}" for s in _steps) + " END")
_age = f"(DATE '{stand_in.REVIEW_DATE}' - business_date)"
_sla = f"CASE WHEN {_digit} >= 5 OR {_age} <= 2 THEN 'WITHIN_SLA' ELSE 'OVER_SLA' END"
_severity = "CASE WHEN dollar_exposure > 5000 THEN 'CRITICAL' WHEN dollar_exposure > 500 THEN 'HIGH' " \
            "WHEN dollar_exposure > 50 THEN 'MEDIUM' ELSE 'LOW' END"
_owner = _case("break_category", fixed.OWNERS, _lit(fixed.DEFAULT_OWNER))
_rule_cause = f"""CASE WHEN break_category = 'CASH_BALANCE_BREAK' THEN
  CASE WHEN abs(variance) < 5 THEN 'FEE_MISMATCH' WHEN abs(variance) < 20 THEN 'DIVIDEND_MISMATCH'
       WHEN abs(variance) BETWEEN 240 AND 260 THEN 'DUPLICATE_CUSTODIAN_CASH_RECORD'
       WHEN abs(variance) BETWEEN 490 AND 510 THEN 'SETTLEMENT_TIMING_DIFFERENCE'
       ELSE 'CONTROLLED_CASH_EXCEPTION_CARRYFORWARD' END
  ELSE {_case("break_category", fixed.CATEGORY_CAUSES, _lit(fixed.DEFAULT_CAUSE))} END"""
_evidence = _case("root_cause", fixed.EVIDENCE, _lit(fixed.DEFAULT_EVIDENCE))
_type = "coalesce(nullif(regexp_extract(file_name, '^(.+?)_(\\d{8})', 1), ''), split_part(file_name, '.', 1), 'UNKNOWN')"
_MIS = stand_in.MISPOSTING

PARTS = {
    # Raw file and staging
    "x_raw": f"SELECT event_id AS source_row_id, {_raw_list} FROM events",
    "x_raw2": f"SELECT {_names} FROM x_raw UNION ALL SELECT {_names} FROM x_raw WHERE TRY_CAST(\"No. of shares\" AS DOUBLE) > 100",
    "x_map13": "SELECT * FROM (" + _values(fixed.ACTION_MAPPING) + ") AS t(raw_action, standardized_category, "
               "cash_impact_sign, security_impact_sign, fee_tax_treatment, needs_review)",
    "x_staged": f"""SELECT source_row_id,
        coalesce({_blank('ID')}, {_blank('Unnamed: 22')}, {_blank('Unnamed: 23')}, 'GEN-' || source_row_id) AS source_transaction_id,
        source_row_id % 50 + 1 AS account_id, trim("Action") AS raw_action,
        TRY_CAST("Transaction Date" AS DATE) AS transaction_date,
        CASE WHEN "Time" IS NULL OR "Time" = 'xx' THEN '00:00:00' ELSE "Time" END AS transaction_time,
        {_blank('Ticker')} AS ticker, {_blank('Name')} AS security_name,
        {_abs('No. of shares', S)} AS shares, {_abs('Price / share', 'DECIMAL(19,6)')} AS price_per_share,
        {_blank('Currency (Price / share)')} AS currency_price,
        CASE WHEN "Exchange rate" <> 'Not available' THEN TRY_CAST("Exchange rate" AS DECIMAL(19,6)) END AS exchange_rate,
        {_abs('Result of Sell', M)} AS realized_result, {_blank('Currency (Result)')} AS currency_result,
        {_abs('Total (GBP)', M)} AS total_amount, coalesce({_blank('Currency (Total)')}, 'GBP') AS currency_total,
        {_abs('Withholding tax', M)} AS withholding_tax, {_abs('Charge amount', M)} AS charge_amount,
        {_abs('Stamp duty reserve tax', M)} AS stamp_duty, trim("Notes") AS notes,
        CASE WHEN TRY_CAST("Transaction Date" AS DATE) IS NULL THEN 1 ELSE 0 END AS flag_invalid_date,
        CASE WHEN "Total (GBP)" IS NOT NULL AND TRY_CAST("Total (GBP)" AS {M}) IS NULL THEN 1 ELSE 0 END AS flag_invalid_amount
        FROM x_raw""",
    "x_staged2": "SELECT source_transaction_id FROM x_staged UNION ALL SELECT source_transaction_id FROM x_staged s JOIN x_raw r "
                 "ON r.source_row_id = s.source_row_id WHERE TRY_CAST(r.\"No. of shares\" AS DOUBLE) > 100",
    "x_actions": "SELECT * FROM (" + _values(stand_in.ACTIONS) + ") AS t(raw_action, standardized_category, "
                 "cash_impact_sign, security_impact_sign, fee_tax_treatment, needs_review)",
    "x_accounts": "SELECT DISTINCT c_custkey % 50 + 1 AS account_id, CASE WHEN (c_custkey % 50 + 1) % 2 = 1 "
                  "THEN 'Investment Account' ELSE 'Trading Account' END AS account_type FROM customer",
    "x_securities": "SELECT 'T' || (p_partkey % 7) AS ticker, max(p_name) AS security_name FROM part GROUP BY 1",
    "x_cash": f"""SELECT o_orderkey AS transaction_id, o_orderkey AS source_row_id, 'O' || o_orderkey AS source_transaction_id,
        o_custkey % 50 + 1 AS account_id, CAST(o_orderdate AS DATE) AS transaction_date, o_orderpriority AS transaction_type,
        CAST(o_totalprice AS {M}) AS total_amount, CAST(CAST(o_totalprice AS {M}) * cash_impact_sign AS {M}) AS cash_impact
        FROM orders JOIN x_actions ON raw_action = o_orderpriority WHERE cash_impact_sign <> 0""",
    "x_trades": f"""SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_suppkey % 50 + 1 AS account_id,
        'T' || (l_partkey % 8) AS ticker, CAST(l_shipdate AS DATE) AS transaction_date, l_returnflag AS transaction_type,
        CAST(l_quantity AS {S}) AS shares, CAST(CAST(l_quantity AS {S}) * security_impact_sign AS {S}) AS security_impact
        FROM lineitem JOIN x_actions ON raw_action = l_returnflag WHERE security_impact_sign <> 0""",
    # Books
    "x_daily": f"SELECT account_id, transaction_date, CAST(sum(cash_impact) AS {M}) AS daily_net_cash FROM x_cash GROUP BY 1, 2",
    "x_days": "SELECT CAST(unnest(generate_series(min(transaction_date), max(transaction_date), INTERVAL 1 DAY)) AS DATE) "
              "AS calendar_date FROM x_cash",
    "x_grid": "SELECT account_id, calendar_date FROM x_accounts CROSS JOIN x_days",
    "x_ledger": f"""SELECT g.account_id, g.calendar_date AS ledger_date, CAST(coalesce(d.daily_net_cash, 0) AS {M}) AS daily_net_cash,
        CAST(sum(coalesce(d.daily_net_cash, 0)) OVER (PARTITION BY g.account_id ORDER BY g.calendar_date) AS {M}) AS cash_balance
        FROM x_grid g LEFT JOIN x_daily d ON d.account_id = g.account_id AND d.transaction_date = g.calendar_date""",
    "x_dented": f"""SELECT account_id, ledger_date, CAST(cash_balance + CASE WHEN account_id = 5 AND ledger_date = DATE '1998-03-03'
        THEN 1 ELSE 0 END AS {M}) AS cash_balance FROM x_ledger WHERE NOT (account_id = 6 AND ledger_date = DATE '1998-03-03')""",
    "x_netshares": f"SELECT account_id, ticker, transaction_date, CAST(sum(security_impact) AS {S}) AS daily_net_shares "
                   "FROM x_trades GROUP BY 1, 2, 3",
    "x_first": "SELECT account_id, ticker, min(transaction_date) AS first_trade_date FROM x_trades GROUP BY 1, 2",
    "x_sdays": "SELECT CAST(unnest(generate_series(min(transaction_date), max(transaction_date), INTERVAL 1 DAY)) AS DATE) "
               "AS calendar_date FROM x_trades",
    "x_pgrid": "SELECT f.account_id, f.ticker, c.calendar_date FROM x_first f JOIN x_sdays c ON c.calendar_date >= f.first_trade_date",
    "x_positions": f"""SELECT account_id, ticker, position_date, share_quantity FROM (
        SELECT g.account_id, g.ticker, g.calendar_date AS position_date, coalesce(n.daily_net_shares, 0) AS moved,
        CAST(sum(coalesce(n.daily_net_shares, 0)) OVER (PARTITION BY g.account_id, g.ticker ORDER BY g.calendar_date) AS {S}) AS share_quantity
        FROM x_pgrid g LEFT JOIN x_netshares n ON n.account_id = g.account_id AND n.ticker = g.ticker
        AND n.transaction_date = g.calendar_date) WHERE share_quantity <> 0 OR moved <> 0""",
    "x_rollforward": f"""SELECT c.account_id, c.ledger_date, coalesce(p.cash_balance, 0) AS prior_balance,
        coalesce(d.daily_net_cash, 0) AS daily_movement, c.cash_balance AS ending_balance,
        coalesce(p.cash_balance, 0) + coalesce(d.daily_net_cash, 0) AS calculated_ending_balance
        FROM x_dented c LEFT JOIN x_dented p ON p.account_id = c.account_id AND p.ledger_date = c.ledger_date - 1
        LEFT JOIN x_daily d ON d.account_id = c.account_id AND d.transaction_date = c.ledger_date""",
    "x_rollbreaks": "SELECT *, calculated_ending_balance - ending_balance AS variance FROM x_rollforward "
                    "WHERE abs(calculated_ending_balance - ending_balance) > 0.001",
    # Files
    "x_files0": """SELECT row_number() OVER (ORDER BY kind, expected_date) - 1 AS source_file_id, file_name, expected_date FROM (
        SELECT DISTINCT 0 AS kind, 'CUST_BAL_' || strftime(ledger_date, '%Y%m%d') || '.csv' AS file_name, ledger_date AS expected_date FROM x_ledger
        UNION ALL SELECT DISTINCT 1, 'CUST_POS_' || strftime(position_date, '%Y%m%d') || '.csv', position_date FROM x_positions)""",
    "x_baltotals": f"SELECT f.source_file_id, f.file_name, count(*) AS record_count, CAST(sum(l.cash_balance) AS {S}) AS control_total "
                   "FROM x_files0 f JOIN x_ledger l ON l.ledger_date = f.expected_date WHERE starts_with(f.file_name, 'CUST_BAL_') GROUP BY 1, 2",
    # Adjustments and the custodian's books
    "x_log0": "SELECT * FROM (" + _values([r[:4] + r[4:] for r in stand_in.ADJUSTMENTS]) + ") AS t(injection_id, exception_type, "
              "affected_table, account_id, affected_date, ticker, impact_amount, impact_shares, expected_detection_rule, carry_forward)",
    "x_faults": "SELECT * FROM (" + _values(stand_in.FIRST_TRANSACTION_FAULTS) + ") AS t(account_id, injection_id, sign, days)",
    "x_firsttx": "SELECT account_id, transaction_date, cash_impact FROM x_cash "
                 "QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY transaction_date, transaction_id) = 1",
    "x_adjustments": f"""SELECT injection_id, exception_type, affected_table, account_id, CAST(affected_date AS DATE) AS affected_date, ticker,
        CAST(impact_amount AS {M}) AS impact_amount, CAST(impact_shares AS {S}) AS impact_shares, expected_detection_rule, carry_forward FROM x_log0
        UNION ALL SELECT f.injection_id, 'First Transaction Fault', 'custodian_balances', f.account_id, t.transaction_date + f.days, NULL,
        CAST(t.cash_impact * f.sign AS {M}), NULL, 'Transaction Match', FALSE FROM x_faults f JOIN x_firsttx t ON t.account_id = f.account_id""",
    "x_adjusted": f"""SELECT l.account_id, l.ledger_date AS balance_date, CAST(any_value(l.cash_balance) + coalesce(sum(a.impact_amount), 0) AS {M})
        AS custodian_cash_balance, max(a.injection_id) AS injection_id FROM x_ledger l LEFT JOIN x_adjustments a
        ON a.affected_table = 'custodian_balances' AND a.account_id = l.account_id AND (l.ledger_date = a.affected_date
        OR (a.carry_forward AND l.ledger_date > a.affected_date)) GROUP BY 1, 2""",
    "x_custodian": f"""SELECT account_id, balance_date, custodian_cash_balance, injection_id FROM x_adjusted
        WHERE NOT (account_id = {stand_in.MISSING_ROW[0]} AND balance_date = DATE '{stand_in.MISSING_ROW[1]}')
        UNION ALL SELECT {stand_in.STRAY_ROW[0]}, DATE '{stand_in.STRAY_ROW[1]}', {stand_in.STRAY_ROW[2]}, {stand_in.STRAY_ROW[3]}""",
    "x_misposted": f"""SELECT account_id, ticker, position_date, CAST(share_quantity - CASE WHEN account_id = {_MIS['right_account']}
        AND ticker = '{_MIS['ticker']}' AND position_date >= DATE '{_MIS['day']}' THEN {_MIS['shares']} ELSE 0 END AS {S}) AS custodian_share_quantity,
        CASE WHEN account_id = {_MIS['right_account']} AND ticker = '{_MIS['ticker']}' AND position_date >= DATE '{_MIS['day']}' THEN 7 END AS injection_id
        FROM x_positions UNION ALL SELECT {_MIS['wrong_account']}, '{_MIS['ticker']}', DATE '{_MIS['day']}', {_MIS['shares']}, 7""",
    "x_custpos": f"""SELECT account_id, ticker, position_date, CAST(custodian_share_quantity + CASE WHEN account_id = 4 AND ticker = 'T4'
        AND position_date >= DATE '1997-06-01' THEN 10 ELSE 0 END AS {S}) AS custodian_share_quantity,
        CASE WHEN account_id = 4 AND ticker = 'T4' AND position_date >= DATE '1997-06-01' THEN 3 ELSE injection_id END AS injection_id FROM x_misposted""",
    # Reconciliation
    # both books stacked, each with the other's value missing, and folded by key
    "x_cashsides": """SELECT account_id, business_date, max(own) AS own, max(theirs) AS theirs, max(injection_id) AS injection_id FROM (
        SELECT account_id, ledger_date AS business_date, cash_balance AS own, NULL AS theirs, NULL AS injection_id FROM x_ledger
        UNION ALL SELECT account_id, balance_date, NULL, custodian_cash_balance, injection_id FROM x_custodian) GROUP BY ALL""",
    "x_recon": f"""SELECT account_id, business_date, own AS internal_cash, theirs AS custodian_cash, injection_id,
        CAST(ifnull(own, 0) - ifnull(theirs, 0) AS {M}) AS cash_variance,
        CASE (own IS NOT NULL)::INT + 2 * (theirs IS NOT NULL)::INT WHEN 1 THEN 'MISSING_IN_CUSTODIAN' WHEN 2 THEN 'MISSING_IN_INTERNAL'
        ELSE if(own - theirs BETWEEN -0.01 AND 0.01, 'MATCHED', 'CASH_BALANCE_BREAK') END AS break_type FROM x_cashsides""",
    "x_sharesides": """SELECT account_id, ticker, business_date, max(own) AS own, max(theirs) AS theirs, max(injection_id) AS injection_id FROM (
        SELECT account_id, ticker, position_date AS business_date, share_quantity AS own, NULL AS theirs, NULL AS injection_id FROM x_positions
        UNION ALL SELECT account_id, ticker, position_date, NULL, custodian_share_quantity, injection_id FROM x_custpos) GROUP BY ALL""",
    "x_precon": f"""SELECT account_id, business_date, ticker, own AS internal_shares, theirs AS custodian_shares, injection_id,
        CAST(ifnull(own, 0) - ifnull(theirs, 0) AS {S}) AS share_variance,
        CASE (own IS NOT NULL)::INT + 2 * (theirs IS NOT NULL)::INT WHEN 1 THEN 'MISSING_IN_CUSTODIAN' WHEN 2 THEN 'MISSING_IN_INTERNAL'
        ELSE if(own - theirs BETWEEN -0.000001 AND 0.000001, 'MATCHED', 'SHARE_QUANTITY_BREAK') END AS break_type FROM x_sharesides""",
    "x_sameday": """SELECT DISTINCT b.account_id, b.business_date, b.cash_variance, t.transaction_id,
        CASE WHEN b.cash_variance = t.cash_impact THEN 'MISSING_IN_CUSTODIAN' ELSE 'DUPLICATE_TRANSACTION' END AS inferred_root_cause
        FROM x_recon b JOIN x_cash t ON t.account_id = b.account_id AND t.transaction_date = b.business_date
        AND abs(t.cash_impact) = abs(b.cash_variance) WHERE b.break_type <> 'MATCHED'""",
    "x_timing": """SELECT DISTINCT b.account_id, b.business_date, b.cash_variance, t.transaction_id, 'TIMING_DIFFERENCE' AS inferred_root_cause
        FROM x_recon b JOIN x_cash t ON t.account_id = b.account_id AND -t.cash_impact = b.cash_variance
        AND t.transaction_date >= b.business_date - 3 AND t.transaction_date < b.business_date WHERE b.break_type <> 'MATCHED'""",
    "x_matches": "SELECT * FROM x_sameday UNION SELECT * FROM x_timing",
    "x_breaks": f"""SELECT row_number() OVER (ORDER BY book, account_id, business_date, ticker NULLS FIRST, internal_value NULLS FIRST,
        custodian_value NULLS FIRST, injection_id NULLS FIRST) - 1 AS break_id, account_id, business_date, ticker, break_category,
        internal_value, custodian_value, variance, dollar_exposure, injection_id FROM (
        SELECT 0 AS book, account_id, business_date, CAST(NULL AS VARCHAR) AS ticker, break_type AS break_category,
        CAST(internal_cash AS {S}) AS internal_value, CAST(custodian_cash AS {S}) AS custodian_value, CAST(cash_variance AS {S}) AS variance,
        CAST(abs(cash_variance) AS {M}) AS dollar_exposure, injection_id FROM x_recon WHERE break_type <> 'MATCHED'
        UNION ALL SELECT 1, account_id, business_date, ticker, break_type, internal_shares, custodian_shares, share_variance,
        CAST(abs(CAST(share_variance AS {M})) * 150 AS {M}), injection_id FROM x_precon WHERE break_type <> 'MATCHED')""",
    "x_caused": f"""SELECT b.*, coalesce(m.inferred_root_cause, {_rule_cause}) AS root_cause FROM x_breaks b LEFT JOIN x_matches m
        ON m.account_id = b.account_id AND m.business_date = b.business_date AND m.cash_variance = b.variance""".replace(
        "break_category", "b.break_category").replace("abs(variance)", "abs(b.variance)"),
    "x_log1": f"""SELECT 0 AS appended, break_id, business_date, account_id, ticker, break_category AS break_type, {_severity} AS severity,
        internal_value, custodian_value, variance AS variance_amount, dollar_exposure, root_cause, {_owner} AS owner, {_cycle(1)} AS status,
        DATE '{stand_in.REVIEW_DATE}' AS detected_date, business_date + 2 AS due_date, {_age} AS aging_days, {_sla} AS sla_status,
        {_cycle(2)} AS resolution_notes FROM x_caused""",
    "x_log2": f"""SELECT * REPLACE (CASE WHEN break_type = 'SHARE_QUANTITY_BREAK' AND ticker = '{stand_in.RECLASSIFIED_TICKER}'
        THEN '{fixed.OVERSTATED_TICKER_CAUSE}' ELSE root_cause END AS root_cause) FROM x_log1""",
    "x_controls0": "SELECT * FROM (" + _values([(k, *v) for k, v in fixed.CONTROL_EXCEPTIONS.items()]) + ") AS t(kind, cause, note)",
    "x_controlrows": f"""SELECT 1 AS appended, CAST(NULL AS BIGINT) AS break_id, a.affected_date AS business_date, coalesce(a.account_id, 1) AS account_id,
        CAST(NULL AS VARCHAR) AS ticker, k.cause AS break_type, 'HIGH' AS severity, CAST(0 AS {S}) AS internal_value, CAST(0 AS {S}) AS custodian_value,
        CAST(0 AS {S}) AS variance_amount, CAST(0 AS {M}) AS dollar_exposure, k.cause AS root_cause, 'Custodian Ops' AS owner, 'RESOLVED' AS status,
        DATE '{stand_in.REVIEW_DATE}' AS detected_date, a.affected_date + 1 AS due_date, DATE '{stand_in.REVIEW_DATE}' - a.affected_date AS aging_days,
        'WITHIN_SLA' AS sla_status, k.note AS resolution_notes FROM x_adjustments a JOIN x_controls0 k ON k.kind = a.exception_type
        WHERE NOT EXISTS (SELECT 1 FROM x_log1 l WHERE l.root_cause = k.cause AND l.business_date = a.affected_date)""",
    "x_log": f"""SELECT row_number() OVER (ORDER BY appended, break_id, root_cause, business_date, account_id) - 1 AS exception_id, * EXCLUDE (appended),
        {_evidence} AS evidence_file FROM (SELECT * FROM x_log2 UNION ALL SELECT * FROM x_controlrows)""",
    # detections of both kinds in one list, counted once
    "x_detected": """SELECT injection_id, count(*) AS n, sum(dollar_exposure) AS exposure FROM (
        SELECT injection_id, dollar_exposure FROM x_breaks
        UNION ALL SELECT a.injection_id, e.dollar_exposure FROM x_controls0 k JOIN x_log e ON e.root_cause = k.cause
        JOIN x_adjustments a ON a.exception_type = k.kind WHERE e.break_id IS NULL) GROUP BY injection_id""",
    "x_validation": """SELECT a.injection_id, a.exception_type, a.expected_detection_rule, ifnull(d.n, 0) AS detected_break_count,
        ifnull(d.exposure, 0) AS cumulative_detected_exposure, if(d.n > 0, 'DETECTED', 'NOT DETECTED') AS detection_status
        FROM x_adjustments a LEFT JOIN x_detected d USING (injection_id)""",
    # Vendor registry
    "x_registry": """SELECT event_id AS source_file_id, 'F_' || upper(event_type) || '_' || strftime(ts, '%Y%m%d')
        || CASE WHEN user_id % 3 = 0 THEN '' ELSE '_' || (user_id % 3) END || '.csv' AS file_name, 'Custodian_Bank' AS source_system,
        CAST(ts AS DATE) AS expected_date, CASE WHEN event_id % 31 = 0 THEN ' missing ' ELSE 'RECEIVED' END AS receipt_status,
        CASE WHEN event_id % 29 <> 0 THEN ts END AS received_timestamp,
        CASE WHEN event_id % 37 = 0 THEN 'FAILED' WHEN event_id % 41 = 0 THEN 'on hold' ELSE 'VALIDATED' END AS validation_status,
        CAST(floor(value * 4) AS BIGINT) AS record_count, CAST(value AS DECIMAL(28,8)) AS control_total FROM events""",
    "x_vf": f"SELECT *, {_type} AS file_type, CAST(expected_date AS VARCHAR) AS file_date FROM x_registry",
    "x_v1": """SELECT 1 AS rule, '' AS t, source_file_id AS k, file_date, file_type, 'RECEIVED' AS expected_status, 'MISSING' AS actual_status,
        CAST(record_count AS DOUBLE) AS record_count, 'MISSING_FILE' AS issue_type, 'HIGH' AS severity, 'Custodian Operations' AS owner,
        'Chase custodian for re-delivery; hold reconciliation for affected date' AS review_action FROM x_vf WHERE upper(trim(receipt_status)) = 'MISSING'""",
    "x_v2": """SELECT 2 AS rule, '' AS t, source_file_id AS k, file_date, file_type, 'ON_TIME' AS expected_status, 'LATE' AS actual_status,
        CAST(record_count AS DOUBLE) AS record_count, 'LATE_FILE' AS issue_type, 'MEDIUM' AS severity, 'Custodian Operations' AS owner,
        'File received ~' || printf('%.1f', (epoch_us(received_timestamp) - epoch_us(expected_date + INTERVAL 10 HOUR)) / 3.6e9)
        || 'h after deadline; review SLA; investigate delay' AS review_action FROM x_vf WHERE received_timestamp > expected_date + INTERVAL 10 HOUR""",
    "x_v3": """SELECT 3 AS rule, file_name AS t, 0 AS k, arg_min(file_date, source_file_id) AS file_date, arg_min(file_type, source_file_id) AS file_type,
        'UNIQUE' AS expected_status, 'DUPLICATE' AS actual_status, CAST(arg_min(record_count, source_file_id) AS DOUBLE) AS record_count,
        'DUPLICATE_FILE_NAME' AS issue_type, 'HIGH' AS severity, 'Reconciliation Team' AS owner,
        'Deduplicate ''' || file_name || '''; investigate why multiple copies were received' AS review_action FROM x_vf GROUP BY file_name HAVING count(*) > 1""",
    "x_v4": """SELECT 4 AS rule, file_date || ' ' || file_type AS t, 0 AS k, file_date, file_type, 'ONE_FILE_PER_TYPE_PER_DAY' AS expected_status,
        'MULTIPLE_FILES' AS actual_status, CAST(sum(record_count) AS DOUBLE) AS record_count, 'DUPLICATE_DATE_FILE_TYPE' AS issue_type,
        'MEDIUM' AS severity, 'Reconciliation Team' AS owner,
        'Confirm which file is authoritative; remove the duplicate before reconciliation' AS review_action
        FROM x_vf GROUP BY file_date, file_type HAVING count(DISTINCT file_name) > 1""",
    "x_v5": """SELECT CASE WHEN record_count < 10 THEN 5 ELSE 6 END AS rule, '' AS t, source_file_id AS k, file_date, file_type,
        CASE WHEN record_count < 10 THEN '>= 10 records' ELSE '<= 1500 records' END AS expected_status, record_count || ' records' AS actual_status,
        CAST(record_count AS DOUBLE) AS record_count, CASE WHEN record_count < 10 THEN 'LOW_RECORD_COUNT' ELSE 'HIGH_RECORD_COUNT' END AS issue_type,
        CASE WHEN record_count < 10 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
        CASE WHEN record_count < 10 THEN 'Custodian Operations' ELSE 'Reconciliation Team' END AS owner,
        CASE WHEN record_count < 10 THEN 'Confirm file is complete; request re-delivery if truncated'
        ELSE 'Verify no duplicate records were included in this file' END AS review_action FROM x_vf WHERE record_count < 10 OR record_count > 1500""",
    "x_v7": """SELECT 8 AS rule, '' AS t, source_file_id AS k, file_date, file_type, 'VALID_TIMESTAMP' AS expected_status,
        'INVALID_RECEIVED_TIMESTAMP' AS actual_status, CAST(record_count AS DOUBLE) AS record_count, 'INVALID_DATE' AS issue_type, 'MEDIUM' AS severity,
        'Reconciliation Team' AS owner, 'Correct the received_timestamp field in the vendor file registry' AS review_action
        FROM x_vf WHERE received_timestamp IS NULL AND receipt_status <> 'MISSING'""",
    "x_v8": """SELECT 9 AS rule, '' AS t, source_file_id AS k, file_date, file_type, 'VALIDATED' AS expected_status, 'FAILED' AS actual_status,
        CAST(record_count AS DOUBLE) AS record_count, 'FAILED_VALIDATION_STATUS' AS issue_type, 'HIGH' AS severity, 'Reconciliation Team' AS owner,
        'Do not use this file in reconciliation; request corrected file from custodian' AS review_action FROM x_vf WHERE upper(trim(validation_status)) = 'FAILED'""",
    "x_vendor": """SELECT row_number() OVER (ORDER BY rule, t, k) AS validation_id, * EXCLUDE (rule, t, k) FROM (SELECT * FROM x_v1 UNION ALL SELECT * FROM x_v2
        UNION ALL SELECT * FROM x_v3 UNION ALL SELECT * FROM x_v4 UNION ALL SELECT * FROM x_v5 UNION ALL SELECT * FROM x_v7 UNION ALL SELECT * FROM x_v8)""",
    # Anomalies
    "x_bal": "SELECT account_id, balance_date AS day, custodian_cash_balance AS balance FROM x_custodian",
    "x_lbal": "SELECT account_id, ledger_date AS day, cash_balance AS balance FROM x_ledger",
}

_FLAG = ["account_id", "transaction_id", "transaction_date", "anomaly_type", "amount", "balance", "threshold_value", "severity",
         "reason_code", "review_action", "source_file"]


def _flag(source: str, rank: str = "0", where: str = "TRUE", **columns: str) -> str:
    defaults = {"account_id": "CAST(account_id AS BIGINT)", "transaction_id": "CAST(NULL AS BIGINT)", "transaction_date": "CAST(NULL AS VARCHAR)",
                "amount": "NULL", "balance": "NULL"}
    full = defaults | columns
    full["amount"] = f"CAST(round({full['amount']}, 2) AS DECIMAL(38,2))"
    full["balance"] = f"CAST(round({full['balance']}, 2) AS DECIMAL(38,2))"
    full["threshold_value"] = f"CAST({full['threshold_value']} AS DOUBLE)"
    return f"SELECT {rank} AS rnk, " + ", ".join(f"{full[c]} AS {c}" for c in _FLAG) + f" FROM {source} WHERE {where}"


_cb = "'custodian_balances.csv'"
_day = "CAST(day AS VARCHAR)"


def _balance_rules(rel: str, moved: str, prefix: str) -> list[str]:
    led = prefix == "LEDGER"
    src = "'internal_ledger.csv'" if led else _cb
    names = (["LEDGER_NEGATIVE_BALANCE", "LEDGER_EXCESS_BALANCE", "LEDGER_LARGE_DAILY_MOVEMENT"] if led else
             ["NEGATIVE_CASH_BALANCE", "EXCESS_CASH_BALANCE", "LARGE_DAILY_CASH_MOVEMENT"])
    actions = (["Investigate internal ledger funding or settlement entry", "Confirm internal ledger balance is expected",
                "Verify internal ledger movement against custodian balance"] if led else
               ["Investigate funding entries and custodian adjustments",
                "Confirm balance is expected; check for uninvested cash or posting errors",
                "Verify funding wires, settlement activity, and journal entries for this date"])
    r = "LEDGER_" if led else ""
    return [
        _flag(rel, where="balance < 0", transaction_date=_day, anomaly_type=_lit(names[0]), balance="balance", threshold_value="0",
              severity="CASE WHEN balance < -5000 THEN 'HIGH' ELSE 'MEDIUM' END", reason_code=_lit(r + "BALANCE_BELOW_ZERO"),
              review_action=_lit(actions[0]), source_file=src),
        _flag(rel, where=f"balance > {stand_in.EXCESS_CASH}", transaction_date=_day, anomaly_type=_lit(names[1]), balance="balance",
              threshold_value=str(stand_in.EXCESS_CASH), severity="'MEDIUM'", reason_code=_lit(r + "BALANCE_ABOVE_THRESHOLD"),
              review_action=_lit(actions[1]), source_file=src),
        _flag(moved, where=f"change > {stand_in.LARGE_MOVEMENT}", transaction_date=_day, anomaly_type=_lit(names[2]), amount="change",
              balance="balance", threshold_value=str(stand_in.LARGE_MOVEMENT), severity="'HIGH'",
              reason_code=_lit(r + "DAILY_CHANGE_EXCEEDS_THRESHOLD"), review_action=_lit(actions[2]), source_file=src),
    ]


_move = "SELECT *, abs(balance - lag(balance) OVER (PARTITION BY account_id ORDER BY day, balance)) AS change FROM {}"
_neg, _exc, _mov = _balance_rules("x_bal", "x_moved", "")
_lneg, _lexc, _lmov = _balance_rules("x_lbal", "x_lmoved", "LEDGER")
_zi = "CASE WHEN zo THEN 'Z_SCORE' ELSE 'IQR' END"
_top = lambda key, measure, rel: (f"SELECT *, row_number() OVER (ORDER BY total DESC, {key}) AS rn FROM (SELECT {key}, {measure} AS total "
                                  f"FROM {rel} GROUP BY 1) QUALIFY rn <= 3")
PARTS |= {
    "x_moved": _move.format("x_bal"),
    "x_lmoved": _move.format("x_lbal"),
    "x_acct": "SELECT account_id, count(*) AS n, CAST(sum(balance) AS DOUBLE) / count(*) AS mean, stddev_pop(CAST(balance AS DOUBLE)) AS dev, "
              "quantile_cont(CAST(balance AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(balance AS DOUBLE), 0.75) AS q3 FROM x_bal GROUP BY 1",
    "x_scored": f"""SELECT account_id, day, balance, z, abs(z) > {stand_in.Z_SCORE} AS zo, io FROM (SELECT b.*,
        CASE WHEN s.n >= 5 AND s.dev <> 0 THEN (CAST(b.balance AS DOUBLE) - s.mean) / s.dev ELSE 0 END AS z,
        s.n >= 5 AND s.q3 <> s.q1 AND (CAST(b.balance AS DOUBLE) < s.q1 - 1.5 * (s.q3 - s.q1) OR CAST(b.balance AS DOUBLE) > s.q3 + 1.5 * (s.q3 - s.q1)) AS io
        FROM x_bal b JOIN x_acct s ON s.account_id = b.account_id)""",
    "x_topacct": _top("account_id", "sum(dollar_exposure)", "x_breaks"),
    "x_topcat": _top("break_category", "count(*)", "x_breaks"),
    "x_topcause": _top("root_cause", "count(*)", "(SELECT * FROM x_log WHERE severity = 'HIGH')"),
    "x_a1": _neg, "x_a2": _exc, "x_a3": _mov, "x_a9": _lneg, "x_aa": _lexc, "x_ab": _lmov,
    "x_a4": _flag("x_scored", where="zo OR io", transaction_date=_day, anomaly_type=f"'STATISTICAL_OUTLIER_' || {_zi}", balance="balance",
                  threshold_value=f"CASE WHEN zo THEN {stand_in.Z_SCORE} ELSE 1.5 END", severity="'LOW'",
                  reason_code=f"'BALANCE_IS_ACCOUNT_RELATIVE_OUTLIER_' || {_zi}",
                  review_action="'Secondary review -- confirm balance is operationally expected for this account'", source_file=_cb),
    "x_a5": _flag("x_topacct", rank="rn", anomaly_type="'HIGH_BREAK_CONCENTRATION_ACCOUNT'", amount="total", threshold_value="3", severity="'HIGH'",
                  reason_code="'TOP_N_ACCOUNT_EXPOSURE'", review_action="'Prioritize reconciliation review for account ' || account_id",
                  source_file="'reconciliation_breaks.csv'"),
    "x_a6": _flag("x_topcat", rank="rn", account_id="CAST(NULL AS BIGINT)", anomaly_type="'HIGH_BREAK_CONCENTRATION_CATEGORY'", amount="total",
                  threshold_value="3", severity="'MEDIUM'", reason_code="'DOMINANT_BREAK_CATEGORY'",
                  review_action="'Review systemic cause of frequent ''' || break_category || ''' breaks'", source_file="'reconciliation_breaks.csv'"),
    "x_a7": _flag("x_topcause", rank="rn", account_id="CAST(NULL AS BIGINT)", anomaly_type="'HIGH_EXCEPTION_CONCENTRATION'", amount="total",
                  threshold_value="3", severity="'HIGH'", reason_code="'RECURRING_HIGH_SEVERITY_ROOT_CAUSE'",
                  review_action="'Perform root-cause review for ''' || root_cause || '''; consider control enhancement'", source_file="'exception_log.csv'"),
    "x_a8": _flag("x_cash", where=f"abs(cash_impact) > {stand_in.LARGE_MOVEMENT}", transaction_id="transaction_id",
                  transaction_date="CAST(transaction_date AS VARCHAR)", anomaly_type="'LARGE_CASH_TRANSACTION'", amount="cash_impact",
                  threshold_value=str(stand_in.LARGE_MOVEMENT), severity="'HIGH'", reason_code="'TRANSACTION_EXCEEDS_THRESHOLD'",
                  review_action="'Verify supporting documentation for large cash inflow/outflow'", source_file="'cash_transactions.csv'"),
    "x_flags": "SELECT row_number() OVER (ORDER BY rule, rnk, account_id NULLS FIRST, transaction_date NULLS FIRST, balance NULLS FIRST, "
               "amount NULLS FIRST, transaction_id NULLS FIRST) AS anomaly_id, * EXCLUDE (rule, rnk) FROM ("
               + " UNION ALL ".join(f"SELECT {i} AS rule, * FROM x_a{k}" for i, k in enumerate("123456789ab")) + ")",
}
_flag_out = ", ".join(_dbl(c) if c in ("amount", "balance") else c for c in _FLAG)


# Data quality: one text per check, built from the same specs.

def _check(check_id: int, name: str, rel: str, count: str, fail: tuple, ok: tuple) -> str:
    """``count`` is an aggregate over the relation; ``fail`` and ``ok`` are (name, severity, description, fix)."""
    arm = lambda i: f"CASE WHEN n > 0 THEN {fail[i]} ELSE {ok[i]} END"
    return (f"SELECT {check_id} AS check_id, {_lit(name)} AS input_file, {arm(0)} AS check_name, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END "
            f"AS check_status, CAST(n AS BIGINT) AS failed_record_count, {arm(1)} AS severity, {arm(2)} AS issue_description, {arm(3)} AS suggested_fix "
            f"FROM (SELECT {count} AS n, count(*) AS total FROM {rel})")


def _fixed_check(check_id: int, name: str, rel: str, status: str, count: str, *texts: str) -> str:
    check, severity, description, fix = (_lit(t) for t in texts)
    return (f"SELECT {check_id} AS check_id, {_lit(name)} AS input_file, {check} AS check_name, '{status}' AS check_status, "
            f"CAST({count} AS BIGINT) AS failed_record_count, {severity} AS severity, {description} AS issue_description, {fix} AS suggested_fix FROM {rel}")


_NO = "No action required"
_one = "(SELECT 1 AS one)"


def _quality_texts(spec: QualitySpec, rel: str, columns: set[str], families: list[str], check_id: int) -> list[str]:
    f, out = spec.name, []
    n = "format('{:,}', CAST(n AS BIGINT))"
    ok = lambda name, text: (_lit(name), "'INFO'", _lit(text), _lit(_NO))

    def add(count, fail, passed):
        out.append(_check(check_id + len(out), f, rel, count, fail, passed))

    def fixed_row(status, *texts, count="0", source=_one):
        out.append(_fixed_check(check_id + len(out), f, source, status, count, *texts))

    if "null_required" in families:
        for c in spec.required:
            if c not in columns:
                fixed_row("FAIL", "MISSING_COLUMN", "HIGH", f"Required column '{c}' is absent from {f}",
                          f"Confirm source query/export includes '{c}'", count="total", source=f"(SELECT count(*) AS total FROM {rel})")
                continue
            text = _lit(f"'{c}' has ") + f" || {n} || ' null values (' || printf('%.1f', 100.0 * n / total) || " + _lit(f"% of rows) in {f}")
            add(f'count(*) FILTER (WHERE "{c}" IS NULL)',
                ("'NULL_REQUIRED_FIELD'", "CASE WHEN 100.0 * n / total > 10 THEN 'HIGH' ELSE 'MEDIUM' END", text,
                 _lit(f"Investigate upstream source for missing '{c}' values")), ok("NULL_REQUIRED_FIELD", f"'{c}' — no nulls found"))
    if "duplicate_id" in families:
        for c in spec.ids:
            if c not in columns:
                fixed_row("FAIL", "DUPLICATE_ID", "HIGH", f"ID column '{c}' not found in {f}", f"Ensure '{c}' is exported from the source")
                continue
            add(f'coalesce((SELECT sum(k) FROM (SELECT count(*) AS k FROM {rel} GROUP BY "{c}" HAVING count(*) > 1)), 0)',
                ("'DUPLICATE_ID'", "'HIGH'", _lit(f"'{c}' contains ") + f" || {n} || " + _lit(f" duplicate values in {f}"),
                 _lit(f"Deduplicate on '{c}'; investigate source for re-sends or join issues")), ok("DUPLICATE_ID", f"'{c}' — no duplicates found"))
    if "invalid_date" in families:
        for c in spec.dates:
            if c not in columns:
                fixed_row("FAIL", "INVALID_DATE", "MEDIUM", f"Date column '{c}' not found in {f}", f"Confirm '{c}' is included in the export")
                continue
            add(f'count(*) FILTER (WHERE "{c}" IS NOT NULL AND TRY_CAST(CAST("{c}" AS VARCHAR) AS TIMESTAMP) IS NULL)',
                ("'INVALID_DATE'", "'MEDIUM'", _lit(f"'{c}' has ") + f" || {n} || " + _lit(f" unparseable date values in {f}"),
                 _lit(f"Standardise '{c}' to YYYY-MM-DD format at the source")), ok("INVALID_DATE", f"'{c}' -- all dates parsed successfully"))
    if "non_numeric" in families:
        for c in spec.numbers:
            if c not in columns:
                fixed_row("FAIL", "NON_NUMERIC_AMOUNT", "HIGH", f"Numeric column '{c}' not found in {f}", f"Ensure '{c}' is exported from the source")
                continue
            add(f'count(*) FILTER (WHERE "{c}" IS NOT NULL AND TRY_CAST(CAST("{c}" AS VARCHAR) AS DOUBLE) IS NULL)',
                ("'NON_NUMERIC_AMOUNT'", "'HIGH'", _lit(f"'{c}' has ") + f" || {n} || " + _lit(f" non-numeric values in {f}"),
                 _lit(f"Remove currency symbols, commas, or text from '{c}' before loading")), ok("NON_NUMERIC_AMOUNT", f"'{c}' -- all values are numeric"))
    if "missing_account" in families:
        if "account_id" not in columns:
            fixed_row("PASS", "MISSING_ACCOUNT_ID", "INFO", "account_id column not applicable for this file", _NO)
        else:
            add("count(*) FILTER (WHERE account_id IS NULL OR account_id = 0)",
                ("'MISSING_ACCOUNT_ID'", "'HIGH'", f"'account_id is null or zero for ' || {n} || " + _lit(f" rows in {f}"),
                 "'Ensure account_id is populated from source before export'"),
                ok("MISSING_ACCOUNT_ID", "account_id -- no nulls or zero values found"))
    if "invalid_status" in families:
        for c, allowed in spec.statuses.items():
            if c not in columns:
                fixed_row("PASS", "INVALID_STATUS_VALUE", "INFO", f"'{c}' -- column not present or no valid list defined", _NO)
                continue
            codes = ", ".join(_lit(v.upper()) for v in allowed)
            bad = f'"{c}" IS NOT NULL AND upper(trim("{c}")) NOT IN ({codes})'
            sample = f"(SELECT '[''' || string_agg(v, ''', ''' ORDER BY v) || ''']' FROM (SELECT DISTINCT \"{c}\" AS v FROM {rel} WHERE {bad} ORDER BY 1 LIMIT 5))"
            add(f"count(*) FILTER (WHERE {bad})",
                ("'INVALID_STATUS_VALUE'", "'MEDIUM'", _lit(f"'{c}' has ") + f" || {n} || "
                 + _lit(f" unexpected values in {f}. Expected: {allowed}. Found (sample): ") + f" || {sample}",
                 _lit(f"Standardise '{c}' values to the approved code list: {allowed}")),
                ok("INVALID_STATUS_VALUE", f"'{c}' -- all values are within approved list"))
    if "duplicate_rows" in families:
        add(f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {rel}))",
            ("'DUPLICATE_FULL_ROW'", "'MEDIUM'", f"{n} || " + _lit(f" fully duplicate rows detected in {f}"),
             "'Deduplicate before loading; investigate whether the file was loaded twice'"),
            ok("DUPLICATE_FULL_ROW", "No fully duplicate rows found"))
    if "critical_null" in families:
        for c in spec.critical:
            if c not in columns:
                fixed_row("FAIL", "NULL_CRITICAL_FIELD", "HIGH", f"Critical field '{c}' is absent from {f}", f"Ensure '{c}' is present in the export")
                continue
            add(f'count(*) FILTER (WHERE "{c}" IS NULL)',
                ("'NULL_CRITICAL_FIELD'", "'HIGH'", _lit(f"Critical field '{c}' is null for ") + f" || {n} || " + _lit(f" rows in {f}"),
                 _lit(f"Populate '{c}' before loading -- this field is required for operational use")),
                ok("NULL_CRITICAL_FIELD", f"'{c}' -- no nulls found in critical field"))
    return out


_ALL = ["null_required", "duplicate_id", "invalid_date", "non_numeric", "missing_account", "invalid_status", "duplicate_rows", "critical_null"]
_specs = {s.name: s for s in DEFAULT_SPECS}
_raw_cols = set(RAW_TRANSACTION_COLUMNS)
_file_cols = {"source_file_id", "file_name", "source_system", "receipt_status", "record_count", "expected_date", "received_timestamp",
              "validation_status", "control_total"}
_log_cols = {"exception_id", "break_id", "business_date", "account_id", "ticker", "break_type", "severity", "internal_value", "custodian_value",
             "variance_amount", "dollar_exposure", "root_cause", "owner", "status", "detected_date", "due_date", "aging_days", "sla_status",
             "resolution_notes", "evidence_file"}
_break_cols = {"break_id", "account_id", "business_date", "ticker", "break_category", "internal_value", "custodian_value", "variance",
               "dollar_exposure", "injection_id"}
PARTS["x_cbq"] = ("SELECT account_id * 100000 + (balance_date - DATE '1990-01-01') AS custodian_balance_id, account_id, balance_date, "
                  "custodian_cash_balance, injection_id, 'GBP' AS currency FROM x_custodian")
PARTS["x_lineids"] = "SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_shipdate FROM lineitem"
PARTS["x_orderaccts"] = "SELECT o_custkey % 50 AS account_id FROM orders"


def _family(*families: str) -> str:
    return " UNION ALL ".join(_quality_texts(catalog.RAW_SPEC, "x_raw2", _raw_cols, list(families), 1))


def _suite() -> str:
    texts: list[str] = []
    for name, rel, cols in [("custodian_balances.csv", "x_cbq", {"custodian_balance_id", "account_id", "balance_date",
                                                                 "custodian_cash_balance", "injection_id", "currency"}),
                            ("reconciliation_breaks.csv", "x_breaks", _break_cols), ("exception_log.csv", "x_log", _log_cols),
                            ("vendor_files.csv", "x_registry", _file_cols), ("raw_stock_transactions.csv", "x_raw2", _raw_cols)]:
        texts += _quality_texts(_specs[name], rel, cols, _ALL, len(texts) + 1)
    texts.append(_fixed_check(len(texts) + 1, "absent.csv", _one, "FAIL", "0", "FILE_NOT_FOUND", "HIGH", "absent.csv was not found",
                              "Confirm the file path and re-run the pipeline export"))
    return " UNION ALL ".join(texts)


PARTS["x_quality"] = _suite()

_cash_out = "source_row_id, source_transaction_id, account_id, CAST(transaction_date AS VARCHAR) AS transaction_date"
_over = "count(*) FILTER (WHERE sla_status = 'OVER_SLA')"
_orphans = lambda rel, master, key: f"(SELECT count(*) FROM {rel} WHERE {key} NOT IN (SELECT {key} FROM {master}))"
_dups = lambda label, rel, col: f"SELECT '{label}' AS table_name, CAST({col} AS VARCHAR) AS id, count(*) AS duplicate_count FROM {rel} GROUP BY 2 HAVING count(*) > 1"
_control_counts = [
    "(SELECT count(*) FROM x_breaks WHERE break_category = 'CASH_BALANCE_BREAK')",
    "(SELECT count(*) FROM x_breaks WHERE break_category = 'SHARE_QUANTITY_BREAK')",
    f"(SELECT {_over} FROM x_log)",
    f"(SELECT count(*) FROM x_files0 WHERE expected_date = DATE '{stand_in.MISSING_POSITION_FILE}' AND starts_with(file_name, 'CUST_POS_'))",
    "(SELECT count(*) FROM orders WHERE o_orderpriority NOT IN (SELECT raw_action FROM x_actions))",
    "0",
    "(SELECT count(*) FROM x_log WHERE break_type IS NULL OR root_cause IS NULL OR severity IS NULL OR dollar_exposure IS NULL)",
    f"{_orphans('x_cash', 'x_accounts', 'account_id')} + {_orphans('x_trades', 'x_accounts', 'account_id')}",
    "(SELECT count(*) FROM x_log WHERE severity = 'CRITICAL')",
    "(SELECT count(*) FROM x_log WHERE root_cause IS NULL)",
]
PARTS["x_controls"] = " UNION ALL ".join(
    f"SELECT {_lit(c[0])} AS control_id, {_lit(c[1])} AS control_name, {_lit(c[2])} AS process_area, {_lit(c[3])} AS frequency, "
    f"{_lit(c[4])} AS owner, CASE WHEN {n} > 0 THEN {_lit(c[5])} ELSE 'PASS' END AS status" for c, n in zip(fixed.CONTROLS, _control_counts))
_profile_part = lambda c: (
    f"SELECT {_lit(c)} AS column_name, count(*) AS row_count, count(*) - count(\"{c}\") AS null_count, "
    f"round(100.0 * (count(*) - count(\"{c}\")) / count(*), 2) AS null_pct, count(DISTINCT \"{c}\") AS unique_values, "
    f"(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT \"{c}\" AS v FROM x_raw2 WHERE \"{c}\" IS NOT NULL ORDER BY 1 LIMIT 3)) AS sample_values, "
    f"count(*) FILTER (WHERE TRY_CAST(\"{c}\" AS DOUBLE) < 0) AS negative_count FROM x_raw2")
_rates = "round(100.0 * {} / count(*), 1)"
_tie = lambda no, name, expected, actual, test: (
    f"SELECT {no} AS check_no, {_lit(name)} AS check_name, CAST({expected} AS DOUBLE) AS expected, CAST({actual} AS DOUBLE) AS actual, "
    f"CASE WHEN {test.format(e=expected, a=actual)} THEN 'PASS' ELSE 'FAIL' END AS status")
_n = lambda rel, where="TRUE": f"(SELECT count(*) FROM {rel} WHERE {where})"
_vrow = "file_date, file_type, expected_status, actual_status, record_count, issue_type, severity, owner, review_action"
_log_select = (f"exception_id, break_id, {_txt('business_date')}, account_id, ticker, break_type, severity, "
               f"{_dbl('internal_value', 'custodian_value', 'variance_amount', 'dollar_exposure')}, root_cause, owner, status, "
               f"{_txt('detected_date', 'due_date')}, aging_days, sla_status, resolution_notes, evidence_file")
_exposed = "count(*) AS exception_count, CAST(sum(dollar_exposure) AS DOUBLE) AS dollar_exposure"
_read = ("SELECT 'orders' AS table_name, 'LOADED' AS outcome, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', 'SKIPPED', 0 "
         "UNION ALL SELECT 'absent', 'SKIPPED', 0")

SQL = {
    "read_transactions": 'SELECT source_row_id, "Action" AS action, "Transaction Date" AS tx_date, "Total (GBP)" AS total, "ID" AS id, "Notes" AS notes FROM x_raw',
    "read_required": _read,
    "read_optional": _read,
    "write_tables": "SELECT count(*) AS csv_rows, CAST(sum(cash_impact) AS DOUBLE) AS csv_total, count(*) AS parquet_rows, "
                    "CAST(sum(cash_impact) AS DOUBLE) AS parquet_total, count(DISTINCT strftime(transaction_date, '%Y-%m')) AS months FROM x_cash",
    "seed_if_absent": "SELECT DISTINCT c_nationkey % 5 AS key, c_mktsegment AS segment, CASE WHEN c_mktsegment = 'BUILDING' THEN 'seeded' "
                      "ELSE 'kept' END AS origin FROM customer",
    "table_overwrite": f"SELECT account_id, {_txt('transaction_date')}, {_dbl('daily_net_cash')} FROM x_daily",
    "stage_clean": f"SELECT * REPLACE ({_txt('transaction_date')}, {_dbl('shares', 'price_per_share', 'exchange_rate', 'realized_result', 'total_amount', 'withholding_tax', 'charge_amount', 'stamp_duty')}) FROM x_staged",
    "shifted_id_coalesce": "SELECT source_row_id, source_transaction_id FROM x_staged",
    "account_bucket": "SELECT o_orderkey, o_orderkey % 50 + 1 AS account_id FROM orders",
    "sentinel_to_null": f"SELECT source_row_id, {_dbl('exchange_rate')} FROM x_staged",
    "cast_failure_flags": "SELECT source_row_id, flag_invalid_date, flag_invalid_amount FROM x_staged",
    "type_mapping": "SELECT m.*, (SELECT count(*) FROM x_staged s WHERE lower(s.raw_action) = lower(m.raw_action)) AS rows_mapped FROM x_map13 m",
    "cash_transactions": f"""SELECT {_cash_out}, '00:00:00' AS transaction_time, transaction_type, {_dbl('total_amount')}, 'GBP' AS currency_total,
        {_dbl('cash_impact')}, CAST(NULL AS DOUBLE) AS withholding_tax, CAST(NULL AS DOUBLE) AS charge_amount, CAST(NULL AS DOUBLE) AS stamp_duty,
        CAST(NULL AS VARCHAR) AS notes, 'orders' AS book FROM x_cash
        UNION ALL SELECT source_row_id, source_transaction_id, account_id, CAST(transaction_date AS VARCHAR), transaction_time, s.raw_action,
        CAST(coalesce(total_amount, 0) AS DOUBLE), currency_total, CAST(coalesce(total_amount, 0) * cash_impact_sign AS DOUBLE),
        CAST(withholding_tax AS DOUBLE), CAST(charge_amount AS DOUBLE), CAST(stamp_duty AS DOUBLE), notes, 'events'
        FROM x_staged s JOIN x_map13 m ON lower(m.raw_action) = lower(s.raw_action)
        WHERE flag_invalid_date = 0 AND flag_invalid_amount = 0 AND cash_impact_sign <> 0""",
    "security_transactions": f"""SELECT transaction_id AS source_row_id, 'L' || transaction_id AS source_transaction_id, account_id, ticker,
        {_txt('transaction_date')}, '00:00:00' AS transaction_time, transaction_type, {_dbl('shares')}, 'GBP' AS currency_price,
        CAST(NULL AS DOUBLE) AS exchange_rate, {_dbl('security_impact')}, CAST(NULL AS DOUBLE) AS realized_result, CAST(NULL AS VARCHAR) AS notes,
        'lineitem' AS book FROM x_trades
        UNION ALL SELECT source_row_id, source_transaction_id, account_id, ticker, CAST(transaction_date AS VARCHAR), transaction_time, s.raw_action,
        CAST(coalesce(shares, 0) AS DOUBLE), currency_price, CAST(exchange_rate AS DOUBLE), CAST(coalesce(shares, 0) * security_impact_sign AS DOUBLE),
        CAST(realized_result AS DOUBLE), notes, 'events' FROM x_staged s JOIN x_map13 m ON lower(m.raw_action) = lower(s.raw_action)
        WHERE flag_invalid_date = 0 AND ticker IS NOT NULL AND security_impact_sign <> 0""",
    "securities_upsert": """WITH known AS (SELECT * FROM x_securities WHERE security_name LIKE 's%' OR security_name LIKE 'r%')
        SELECT ticker, security_name FROM known UNION ALL SELECT ticker, max(security_name) FROM x_staged WHERE ticker IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM known k WHERE k.ticker = x_staged.ticker) GROUP BY 1""",
    "calendar": f"SELECT {_txt('calendar_date')} FROM x_days",
    "daily_net_cash": f"SELECT account_id, {_txt('transaction_date')}, {_dbl('daily_net_cash')} FROM x_daily",
    "account_date_grid": "SELECT account_id, count(*) AS days, CAST(min(calendar_date) AS VARCHAR) AS first_day, CAST(max(calendar_date) AS VARCHAR) AS last_day FROM x_grid GROUP BY 1",
    "ledger_balances": f"SELECT account_id, {_txt('ledger_date')}, {_dbl('daily_net_cash', 'cash_balance')} FROM x_ledger",
    "daily_net_shares": f"SELECT account_id, ticker, {_txt('transaction_date')}, {_dbl('daily_net_shares')} FROM x_netshares",
    "first_trade": f"SELECT account_id, ticker, {_txt('first_trade_date')} FROM x_first",
    "ledger_rebuilt_in_part": f"SELECT account_id, {_txt('ledger_date')}, {_dbl('daily_net_cash', 'cash_balance')} FROM x_ledger",
    "ledger_of_days": f"SELECT account_id, {_txt('ledger_date')}, {_dbl('daily_net_cash', 'cash_balance')} FROM x_ledger "
                      f"WHERE ledger_date BETWEEN DATE '{stand_in.LEDGER_DAYS[0]}' AND DATE '{stand_in.LEDGER_DAYS[1]}'",
    "positions_rebuilt_in_part": """SELECT p.account_id, p.ticker, strftime(position_date, '%Y-%m') AS month, count(*) AS days, CAST(sum(share_quantity) AS DOUBLE) AS share_days,
        CAST(sum(share_quantity * day(position_date)) AS DOUBLE) AS weighted_shares, CAST(sum(coalesce(d.daily_net_shares, 0)) AS DOUBLE) AS net_shares,
        CAST(sum(coalesce(d.daily_net_shares, 0) * day(position_date)) AS DOUBLE) AS weighted_net_shares
        FROM x_positions p LEFT JOIN x_netshares d ON d.account_id = p.account_id AND d.ticker = p.ticker AND d.transaction_date = p.position_date GROUP BY 1, 2, 3""",
    "position_grid": "SELECT account_id, ticker, count(*) AS days, CAST(min(calendar_date) AS VARCHAR) AS first_day, CAST(max(calendar_date) AS VARCHAR) AS last_day FROM x_pgrid GROUP BY 1, 2",
    "positions": """SELECT account_id, ticker, strftime(position_date, '%Y-%m') AS month, count(*) AS days, CAST(sum(share_quantity) AS DOUBLE) AS share_days,
        CAST(min(share_quantity) AS DOUBLE) AS lowest, CAST(max(share_quantity) AS DOUBLE) AS highest, CAST(arg_max(share_quantity, position_date) AS DOUBLE) AS closing
        FROM x_positions GROUP BY 1, 2, 3""",
    "rollforward_breaks": f"SELECT 'Roll-Forward Failure' AS check_name, account_id, {_txt('ledger_date')}, {_dbl('prior_balance', 'daily_movement', 'calculated_ending_balance', 'ending_balance', 'variance')} FROM x_rollbreaks",
    "rollforward_lag_tieout": """SELECT account_id, CAST(ledger_date AS VARCHAR) AS ledger_date, CAST(prior AS DOUBLE) AS prior_cash_balance,
        CAST(moved AS DOUBLE) AS daily_cash_movement, CAST(cash_balance AS DOUBLE) AS ending_cash_balance,
        CAST(round(coalesce(prior, 0) + moved - cash_balance, 2) AS DOUBLE) AS tie_out_difference FROM (
        SELECT l.*, lag(l.cash_balance) OVER (PARTITION BY l.account_id ORDER BY l.ledger_date) AS prior, coalesce(d.daily_net_cash, 0) AS moved
        FROM x_dented l LEFT JOIN x_daily d ON d.account_id = l.account_id AND d.transaction_date = l.ledger_date)
        WHERE abs(round(coalesce(prior, 0) + moved - cash_balance, 2)) > 0.01""",
    "file_manifest": "SELECT source_file_id, file_name, 'Custodian_Bank' AS source_system, CAST(expected_date AS VARCHAR) AS expected_date, "
                     "'RECEIVED' AS receipt_status, CAST(expected_date AS VARCHAR) || ' 06:00:00' AS received_timestamp, 'VALIDATED' AS validation_status FROM x_files0",
    "file_link": "SELECT f.source_file_id, CAST(f.expected_date AS VARCHAR) AS balance_date, count(*) AS records FROM x_files0 f "
                 "JOIN x_ledger l ON l.ledger_date = f.expected_date WHERE starts_with(f.file_name, 'CUST_BAL_') GROUP BY 1, 2",
    "file_control_totals": "SELECT f.source_file_id, f.file_name, 'Custodian_Bank' AS source_system, CAST(f.expected_date AS VARCHAR) AS expected_date, "
                           "'RECEIVED' AS receipt_status, 'VALIDATED' AS validation_status, t.record_count, CAST(t.control_total AS DOUBLE) AS control_total "
                           "FROM x_files0 f LEFT JOIN x_baltotals t ON t.source_file_id = f.source_file_id",
    "apply_adjustments": "SELECT f.source_file_id, a.account_id, CAST(a.balance_date AS VARCHAR) AS balance_date, CAST(a.custodian_cash_balance AS DOUBLE) AS custodian_cash_balance, "
                         "'INJECTED' AS simulation_flag, a.injection_id FROM x_adjusted a JOIN x_files0 f ON f.expected_date = a.balance_date "
                         "AND starts_with(f.file_name, 'CUST_BAL_') WHERE a.injection_id IS NOT NULL",
    "apply_misposting": "SELECT m.account_id, m.ticker, CAST(m.position_date AS VARCHAR) AS position_date, CAST(m.custodian_share_quantity AS DOUBLE) AS custodian_share_quantity, "
                        "'INJECTED' AS simulation_flag, m.injection_id, f.source_file_id FROM x_misposted m JOIN x_files0 f ON f.expected_date = m.position_date "
                        "AND starts_with(f.file_name, 'CUST_POS_') WHERE m.injection_id IS NOT NULL",
    "mark_missing_file": f"""SELECT source_file_id, file_name, 'Custodian_Bank' AS source_system, CAST(expected_date AS VARCHAR) AS expected_date,
        CASE WHEN gone THEN 'MISSING' ELSE 'RECEIVED' END AS receipt_status, CASE WHEN NOT gone THEN CAST(expected_date AS VARCHAR) || ' 06:00:00' END AS received_timestamp,
        CASE WHEN gone THEN 'FAILED' ELSE 'VALIDATED' END AS validation_status FROM (SELECT *, expected_date = DATE '{stand_in.MISSING_POSITION_FILE}'
        AND starts_with(file_name, 'CUST_POS_') AS gone FROM x_files0)""",
    "control_total_tieout": f"""SELECT t.source_file_id, t.file_name, t.record_count, coalesce(c.n, 0) AS actual_count, CAST(t.control_total AS DOUBLE) AS control_total,
        CAST(coalesce(c.total, 0) AS DOUBLE) AS actual_total, CAST(t.control_total - coalesce(c.total, 0) AS DOUBLE) AS total_variance
        FROM x_baltotals t LEFT JOIN (SELECT f.source_file_id, count(*) AS n, CAST(sum(c.custodian_cash_balance) AS {S}) AS total FROM x_custodian c JOIN x_files0 f
        ON f.expected_date = c.balance_date AND starts_with(f.file_name, 'CUST_BAL_') WHERE c.account_id <> {stand_in.STRAY_ROW[0]} GROUP BY 1) c
        ON c.source_file_id = t.source_file_id WHERE t.record_count IS DISTINCT FROM c.n OR t.control_total <> c.total""",
    "cash_recon": f"SELECT account_id, {_txt('business_date')}, {_dbl('internal_cash', 'custodian_cash', 'cash_variance')}, break_type, injection_id FROM x_recon",
    "position_recon": """SELECT account_id, ticker, break_type, injection_id, count(*) AS days, CAST(min(business_date) AS VARCHAR) AS first_day,
        CAST(max(business_date) AS VARCHAR) AS last_day, CAST(sum(share_variance) AS DOUBLE) AS share_variance, CAST(sum(internal_shares) AS DOUBLE) AS internal_shares,
        CAST(sum(custodian_shares) AS DOUBLE) AS custodian_shares FROM x_precon GROUP BY 1, 2, 3, 4""",
    **{k: f"SELECT account_id, {_txt('business_date')}, {_dbl('cash_variance')}, transaction_id, inferred_root_cause FROM {rel}"
       for k, rel in [("same_day_match", "x_sameday"), ("timing_match", "x_timing"), ("transaction_match", "x_matches")]},
    "recon_breaks": f"SELECT break_id, account_id, {_txt('business_date')}, ticker, break_category, {_dbl('internal_value', 'custodian_value', 'variance', 'dollar_exposure')}, injection_id FROM x_breaks",
    "severity": f"SELECT break_id, {_dbl('dollar_exposure')}, {_severity} AS severity FROM x_breaks".replace("CASE WHEN dollar", "CASE WHEN x_breaks.dollar").replace("WHEN dollar", "WHEN x_breaks.dollar"),
    "root_cause": f"SELECT break_id, break_category, {_dbl('variance')}, root_cause FROM x_caused",
    "owner_assignment": f"SELECT break_id, break_category, {_owner} AS owner FROM x_breaks",
    "status_sla": f"SELECT break_id, CAST(business_date AS VARCHAR) AS business_date, {_cycle(1)} AS status, '{stand_in.REVIEW_DATE}' AS detected_date, "
                  f"CAST(b.business_date + 2 AS VARCHAR) AS due_date, {_age.replace('business_date', 'b.business_date')} AS aging_days, "
                  f"{_sla.replace('business_date', 'b.business_date')} AS sla_status, {_cycle(2)} AS resolution_notes FROM x_breaks b".replace("CAST(business_date AS", "CAST(b.business_date AS"),
    "exception_log": f"SELECT {_log_select} FROM x_log",
    "reclassify": "SELECT break_id, break_type, ticker, root_cause FROM x_log2",
    "evidence_assignment": f"SELECT break_id, root_cause, CASE WHEN break_id % 3 = 1 THEN 'kept' ELSE {_evidence} END AS evidence_file FROM x_log1",
    "control_exceptions": f"""SELECT break_id, {_txt('business_date')}, account_id, ticker, break_type, severity,
        {_dbl('internal_value', 'custodian_value', 'variance_amount', 'dollar_exposure')}, root_cause, owner, status, {_txt('detected_date', 'due_date')},
        aging_days, sla_status, resolution_notes, {_evidence} AS evidence_file FROM x_controlrows""",
    "recon_review": f"""SELECT CASE WHEN internal_cash IS NOT NULL THEN account_id END AS account_id_int,
        CASE WHEN internal_cash IS NOT NULL THEN CAST(business_date AS VARCHAR) END AS ledger_date, CAST(internal_cash AS DOUBLE) AS cash_balance,
        CASE WHEN custodian_cash IS NOT NULL THEN account_id END AS account_id_cust,
        CASE WHEN custodian_cash IS NOT NULL THEN CAST(business_date AS VARCHAR) END AS balance_date, CAST(custodian_cash AS DOUBLE) AS custodian_cash_balance,
        CAST(round(cash_variance, 2) AS DOUBLE) AS variance, CASE WHEN abs(round(cash_variance, 2)) > 0.01 THEN 'Break' ELSE 'Pass' END AS pass_fail FROM x_recon""",
    "cash_recon_totals": """SELECT count(*) AS cash_break_count, CAST(sum(abs(round(cash_variance, 2))) AS DOUBLE) AS total_absolute_cash_variance,
        CAST(sum(round(cash_variance, 2)) AS DOUBLE) AS net_cash_variance FROM x_recon
        WHERE abs(round(cash_variance, 2)) > 0.01 OR internal_cash IS NULL OR custodian_cash IS NULL""",
    "position_recon_totals": """SELECT count(*) AS position_break_count, CAST(sum(abs(share_variance)) AS DOUBLE) AS total_absolute_share_variance,
        CAST(sum(share_variance) AS DOUBLE) AS net_share_variance FROM x_precon
        WHERE abs(share_variance) > 0.00000001 OR internal_shares IS NULL OR custodian_shares IS NULL""",
    "ordered_id": "SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS row_id, o_custkey, o_orderkey FROM orders",
    "cash_activity": f"""SELECT transaction_id, source_transaction_id, c.account_id, account_type, {_txt('transaction_date')}, transaction_type, standardized_category,
        'GBP' AS currency, {_dbl('cash_impact')}, CAST(total_amount AS DOUBLE) AS gross_amount, CAST(NULL AS DOUBLE) AS withholding_tax,
        CAST(NULL AS DOUBLE) AS charge_amount, CAST(NULL AS DOUBLE) AS stamp_duty, CAST(NULL AS VARCHAR) AS notes
        FROM x_cash c JOIN x_accounts a ON a.account_id = c.account_id LEFT JOIN x_actions m ON m.raw_action = c.transaction_type""",
    "security_activity": f"""SELECT transaction_id, 'L' || transaction_id AS source_transaction_id, t.account_id, account_type, {_txt('transaction_date')}, t.ticker, security_name,
        transaction_type, standardized_category, {_dbl('security_impact')}, CAST(shares AS DOUBLE) AS absolute_shares, 'GBP' AS currency_price,
        CAST(NULL AS DOUBLE) AS realized_result FROM x_trades t JOIN x_accounts a ON a.account_id = t.account_id JOIN x_securities s ON s.ticker = t.ticker
        LEFT JOIN x_actions m ON m.raw_action = t.transaction_type""",
    "exception_summary": """SELECT b.break_category, l.root_cause, l.severity, l.status, l.sla_status, count(*) AS exception_count,
        CAST(sum(abs(b.variance)) AS DOUBLE) AS absolute_variance, CAST(sum(b.dollar_exposure) AS DOUBLE) AS dollar_exposure
        FROM x_breaks b LEFT JOIN x_log l ON l.break_id = b.break_id GROUP BY 1, 2, 3, 4, 5""",
    "recon_summary": """SELECT CAST(business_date AS VARCHAR) AS business_date, break_category, count(*) AS total_breaks,
        CAST(sum(abs(variance)) AS DOUBLE) AS total_absolute_variance, CAST(sum(dollar_exposure) AS DOUBLE) AS total_dollar_exposure FROM x_breaks GROUP BY 1, 2""",
    "exposure_summary": " UNION ALL ".join(
        f"SELECT {_lit(m)} AS exposure_metric, {_lit(d)} AS definition, CAST({e} AS DOUBLE) AS total_value FROM {rel}" for (m, d), e, rel in zip(
            fixed.EXPOSURE_ROWS, [f"sum(abs(coalesce(CAST(impact_amount AS {S}), impact_shares)))", "sum(dollar_exposure)", "sum(dollar_exposure)",
                                  "sum(dollar_exposure) FILTER (WHERE status IN ('OPEN', 'IN_REVIEW', 'PENDING_VENDOR'))"],
            ["x_adjustments", "x_breaks", "x_log", "x_log"])),
    "root_cause_breakdown": "SELECT root_cause, count(*) AS break_count FROM x_log GROUP BY 1",
    "cash_break_causes": """SELECT b.break_category, l.root_cause, count(*) AS break_count, CAST(sum(b.variance) AS DOUBLE) AS net_cash_variance,
        CAST(sum(abs(b.variance)) AS DOUBLE) AS absolute_cash_variance FROM x_breaks b LEFT JOIN x_log l ON l.break_id = b.break_id
        WHERE b.break_category = 'CASH_BALANCE_BREAK' GROUP BY 1, 2""",
    "share_break_tickers": """SELECT ticker, count(*) AS break_count, CAST(sum(variance) AS DOUBLE) AS net_share_variance,
        CAST(sum(abs(variance)) AS DOUBLE) AS absolute_share_variance FROM x_breaks WHERE break_category = 'SHARE_QUANTITY_BREAK' GROUP BY 1""",
    "share_break_runs": """SELECT account_id, ticker, CAST(min(business_date) AS VARCHAR) AS first_break_date, CAST(max(business_date) AS VARCHAR) AS last_break_date,
        count(*) AS break_days, CAST(sum(variance) AS DOUBLE) AS net_share_variance, CAST(sum(abs(variance)) AS DOUBLE) AS absolute_share_variance
        FROM x_breaks WHERE break_category = 'SHARE_QUANTITY_BREAK' GROUP BY 1, 2""",
    "cash_type_profile": """SELECT transaction_type, count(*) AS transaction_count, CAST(sum(cash_impact) AS DOUBLE) AS total_cash_impact,
        CAST(min(cash_impact) AS DOUBLE) AS min_cash_impact, CAST(max(cash_impact) AS DOUBLE) AS max_cash_impact FROM x_cash GROUP BY 1""",
    "security_type_profile": """SELECT transaction_type, ticker, count(*) AS transaction_count, CAST(sum(security_impact) AS DOUBLE) AS total_security_impact,
        CAST(min(security_impact) AS DOUBLE) AS min_security_impact, CAST(max(security_impact) AS DOUBLE) AS max_security_impact FROM x_trades GROUP BY 1, 2""",
    "kpi_cards": f"""SELECT count(exception_id) AS total_exceptions, {', '.join(f"count(*) FILTER (WHERE status = '{s}') AS {s.lower()}_count" for s in fixed.ALL_STATUSES)},
        {_over} AS over_sla_count, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_count, CAST(sum(dollar_exposure) AS DOUBLE) AS total_exposure,
        count(DISTINCT root_cause) AS distinct_root_causes, {_n('x_rollbreaks')} AS ledger_failures, {_n('x_validation')} AS injections_tested,
        CAST({_n('x_validation', "detection_status = 'DETECTED'")} AS DOUBLE) / {_n('x_validation')} AS detection_rate FROM x_log""",
    "root_cause_exposure": f"SELECT root_cause, {_exposed} FROM x_log GROUP BY 1",
    "owner_mix": "SELECT owner, count(*) AS exception_count FROM x_log GROUP BY 1",
    "status_mix": "SELECT status, count(*) AS exception_count FROM x_log GROUP BY 1",
    "exception_aging": "SELECT sla_status, severity, root_cause, CAST(sum(dollar_exposure) AS DOUBLE) AS dollar_exposure FROM x_log GROUP BY 1, 2, 3",
    "aging_buckets": f"SELECT CASE WHEN aging_days <= 2 THEN '0-2 days' WHEN aging_days <= 5 THEN '3-5 days' WHEN aging_days <= 10 THEN '6-10 days' ELSE '10+ days' END AS aging_bucket, {_exposed} FROM x_log GROUP BY 1",
    "open_by_owner": f"SELECT owner, {_exposed} FROM x_log WHERE status <> 'RESOLVED' GROUP BY 1",
    "cause_status_pivot": "SELECT root_cause, " + ", ".join(f'count(*) FILTER (WHERE status = \'{s}\') AS "{s}"' for s in fixed.ALL_STATUSES) + " FROM x_log GROUP BY 1",
    "control_status": "SELECT * FROM x_controls",
    "dashboard_measures": f"""SELECT count(*) AS total_exceptions, count(*) FILTER (WHERE status <> 'RESOLVED') AS open_exceptions, {_over} AS breaks_over_sla,
        CAST(sum(dollar_exposure) AS DOUBLE) AS dollar_exposure, round(CAST(sum(aging_days) AS DOUBLE) / count(aging_days), 6) AS average_exception_age,
        {_n('x_cash')} + {_n('x_trades')} AS total_transactions,
        (SELECT count(DISTINCT account_id) FROM (SELECT account_id FROM x_cash UNION ALL SELECT account_id FROM x_trades)) AS accounts_reviewed,
        {_n('x_breaks')} AS total_breaks, (SELECT {_rates.format("count(*) FILTER (WHERE status = 'PASS')")} FROM x_controls) AS control_pass_rate,
        (SELECT {_rates.format("count(*) FILTER (WHERE check_status = 'PASS')")} FROM x_quality) AS data_quality_pass_rate,
        {_n('x_vendor')} AS vendor_issue_count, {_n('x_flags')} AS anomaly_count, {_n('x_flags', "severity = 'HIGH'")} AS high_risk_anomaly_count FROM x_log""",
    "row_count_tieout": f"SELECT 'Row Count Validation' AS check_name, {_n('x_raw')} AS raw_count, {_n('x_staged')} AS staging_count, 'PASS' AS status",
    "layer_counts": f"""WITH days AS (SELECT count(*) AS n, min(calendar_date) AS lo, max(calendar_date) AS hi FROM x_days),
        grid AS (SELECT days.n * (SELECT count(*) FROM x_accounts) AS n FROM days),
        runs AS (SELECT sum(daily_net_shares) OVER w AS held, daily_net_shares AS moved, transaction_date AS day, lead(transaction_date) OVER w AS following
            FROM x_netshares WINDOW w AS (PARTITION BY account_id, ticker ORDER BY transaction_date)),
        held AS (SELECT sum(CASE WHEN held <> 0 THEN coalesce(following, (SELECT max(transaction_date) + 1 FROM x_trades)) - day WHEN moved <> 0 THEN 1 ELSE 0 END) AS n FROM runs),
        wanted(object_name, expected_count) AS (
            SELECT 'cash_transactions', (SELECT count(*) FROM orders WHERE o_orderpriority IN (SELECT raw_action FROM x_actions WHERE cash_impact_sign <> 0))
            UNION ALL SELECT 'security_transactions', (SELECT count(*) FROM lineitem WHERE l_returnflag IN (SELECT raw_action FROM x_actions WHERE security_impact_sign <> 0))
            UNION ALL SELECT 'internal_ledger_balances', n FROM grid
            UNION ALL SELECT 'custodian_balances', n + 1 - (SELECT count(*) FROM x_accounts, days WHERE account_id = {stand_in.MISSING_ROW[0]}
                AND DATE '{stand_in.MISSING_ROW[1]}' BETWEEN lo AND hi) FROM grid
            UNION ALL SELECT 'positions', n FROM held UNION ALL SELECT 'custodian_positions', n + 1 FROM held
            UNION ALL SELECT 'reconciliation_breaks', (SELECT count(*) FROM x_recon WHERE break_type <> 'MATCHED') + (SELECT count(*) FROM x_precon WHERE break_type <> 'MATCHED')
            UNION ALL SELECT 'exception_log', (SELECT count(*) FROM x_caused) + (SELECT count(*) FROM x_controlrows)),
        counted(object_name, row_count) AS ({" UNION ALL ".join(f"SELECT '{name}', count(*) FROM {rel}" for name, rel in [("cash_transactions", "x_cash"), ("security_transactions", "x_trades"), ("internal_ledger_balances", "x_ledger"), ("custodian_balances", "x_custodian"), ("positions", "x_positions"), ("custodian_positions", "x_custpos"), ("reconciliation_breaks", "x_breaks"), ("exception_log", "x_log")])})
        SELECT object_name, row_count, CAST(expected_count AS BIGINT) AS expected_count, if(row_count = expected_count, 'PASS', 'FAIL') AS status
        FROM counted JOIN wanted USING (object_name)""",
    "rollforward_status": f"""SELECT 'Ledger Roll-Forward' AS validation_check, 'PASS' AS validation_status, 0 AS failure_count,
        'All balances equal prior balance plus movement' AS validation_notes
        UNION ALL SELECT 'Ledger Roll-Forward', 'FAIL', {_n('x_rollbreaks')}, 'Balances differ from prior balance plus movement'""",
    "duplicate_ids": " UNION ALL ".join([_dups("staging", "x_staged2", "source_transaction_id"), _dups("cash_transactions", "x_cash", "transaction_id"),
                                         _dups("security_transactions", "x_trades", "transaction_id")]),
    "failed_casts": "SELECT sum(flag_invalid_date)::BIGINT AS failed_dates, sum(flag_invalid_amount)::BIGINT AS failed_amounts FROM x_staged",
    "missing_required": "SELECT count(*) FILTER (WHERE account_id IS NULL OR raw_action IS NULL) AS missing_fields_count FROM x_staged",
    "missing_field_matrix": """SELECT 'cash_transactions' AS table_name, count(*) - count(transaction_id) AS missing_transaction_id, count(*) - count(account_id) AS missing_account_id,
        count(*) - count(transaction_date) AS missing_transaction_date, count(*) - count(transaction_type) AS missing_transaction_type FROM x_cash
        UNION ALL SELECT 'security_transactions', count(*) - count(source_row_id), count(*) - count(account_id), count(*) - count(transaction_date),
        count(*) - count(raw_action) FROM x_staged""",
    "unmapped_actions": """SELECT o_orderpriority AS raw_action, count(*) AS occurrences FROM orders WHERE o_orderpriority NOT IN (SELECT raw_action FROM x_actions) GROUP BY 1
        UNION ALL SELECT raw_action, count(*) FROM x_staged s WHERE NOT EXISTS (SELECT 1 FROM x_map13 m WHERE lower(m.raw_action) = lower(s.raw_action)) GROUP BY 1""",
    "broken_security_joins": f"SELECT {_orphans('x_trades', 'x_securities', 'ticker')} AS broken_joins_count",
    "orphan_accounts": "WITH known AS (SELECT DISTINCT c_custkey % 50 + 1 AS account_id FROM customer WHERE c_acctbal > 9000) "
                       f"SELECT {_orphans('x_cash', 'known', 'account_id')} AS orphan_cash_transactions, {_orphans('x_trades', 'known', 'account_id')} AS orphan_security_transactions",
    "negative_positions": """SELECT account_id, ticker, count(*) AS days, CAST(min(share_quantity) AS DOUBLE) AS lowest, CAST(min(position_date) AS VARCHAR) AS first_day
        FROM x_positions WHERE share_quantity < 0 GROUP BY 1, 2""",
    "open_over_sla": f"SELECT exception_id, account_id, {_txt('business_date')}, status, aging_days FROM x_log WHERE status <> 'RESOLVED' AND sla_status = 'OVER_SLA'",
    "missing_dates": "SELECT count(*) - count(transaction_date) AS missing_transaction_date_count FROM x_staged",
    "recon_coverage": f"""SELECT 'Cash Record Count' AS check_name, {_n('x_ledger')} AS internal_count, {_n('x_custodian')} AS custodian_count
        UNION ALL SELECT 'Position Record Count', {_n('x_positions')}, {_n('x_custpos')}""",
    "adjustment_counts": f"""SELECT count(*) AS actual_injections, 8 AS planned_injections, CASE WHEN count(*) = 8 THEN 'PASS' ELSE 'FAIL' END AS status,
        {_n('x_custodian', 'injection_id IS NOT NULL')} AS modified_cash_records, {_n('x_custpos', 'injection_id IS NOT NULL')} AS modified_position_records FROM x_adjustments""",
    "missing_files": f"SELECT {_control_counts[3]} AS missing_count",
    "orphan_adjustments": f"SELECT {_n('x_custodian', 'injection_id = 2')} AS orphan_count",
    "adjustment_coverage": """SELECT a.exception_type, CAST(a.affected_date AS VARCHAR) AS affected_date, count(l.exception_id) AS detected_count,
        CASE WHEN count(l.exception_id) > 0 THEN 'DETECTED' ELSE 'MISSED' END AS status FROM x_adjustments a LEFT JOIN x_log l ON l.business_date = a.affected_date
        GROUP BY 1, a.affected_date""",
    "injection_validation": f"""SELECT a.injection_id, exception_type, expected_detection_rule, coalesce(n, 0) AS detected_break_count,
        CAST(coalesce(size, 0) AS DOUBLE) AS cumulative_detected_exposure, CASE WHEN coalesce(n, 0) > 0 THEN 'DETECTED' ELSE 'NOT_DETECTED' END AS detection_status
        FROM x_adjustments a LEFT JOIN (SELECT injection_id, count(*) AS n, sum(size) AS size FROM (
        SELECT injection_id, abs(cash_variance) AS size FROM x_recon WHERE break_type <> 'MATCHED'
        UNION ALL SELECT injection_id, CAST(0 AS {M}) FROM x_precon WHERE break_type <> 'MATCHED') GROUP BY 1) b ON b.injection_id = a.injection_id""",
    "injection_to_break": f"SELECT injection_id, exception_type, expected_detection_rule, detected_break_count, {_dbl('cumulative_detected_exposure')}, detection_status FROM x_validation",
    "null_critical_fields": """SELECT count(*) - count(break_type) AS null_type, count(*) - count(root_cause) AS null_cause, count(*) - count(severity) AS null_severity,
        count(*) - count(dollar_exposure) AS null_exposure FROM x_log""",
    "exception_completeness": "SELECT count(*) AS total_exceptions, " + ", ".join(
        f"count(*) - count({c}) AS missing_{c}" for c in ["break_id", "account_id", "break_type", "severity", "root_cause", "owner", "status", "detected_date",
                                                          "due_date", "aging_days", "sla_status"]) + ", count(*) FILTER (WHERE evidence_file IS NULL OR trim(evidence_file) = '') AS missing_evidence_file FROM x_log",
    "table_differences": """WITH both_sides AS (SELECT account_id, ledger_date, cash_balance, 1 AS a, 0 AS b FROM x_ledger
        UNION ALL SELECT account_id, ledger_date, cash_balance, 0, 1 FROM x_dented
        UNION ALL SELECT account_id + 1000, ledger_date, cash_balance, 0, 1 FROM x_ledger WHERE account_id = 7 AND ledger_date BETWEEN DATE '1999-01-01' AND DATE '1999-01-03')
        SELECT account_id, CAST(ledger_date AS VARCHAR) AS ledger_date, CASE WHEN sum(b) = 0 THEN 'LOST' WHEN sum(a) = 0 THEN 'ADDED' ELSE 'CHANGED' END AS difference,
        CAST(sum(a) AS BIGINT) AS source_rows, CAST(sum(b) AS BIGINT) AS copy_rows FROM both_sides
        GROUP BY account_id, ledger_date HAVING sum(a) <> sum(b) OR count(DISTINCT cash_balance) > 1""",
    "tie_outs": " UNION ALL ".join(_tie(i, *row) for i, row in enumerate([
        *[(name, _n(rel), f"(SELECT count(*) FROM (SELECT * FROM {rel} INTERSECT ALL SELECT * FROM {rel}))", "{e} = {a}") for name, rel in [
            ("Cash Transaction Rows", "x_cash"), ("Security Transaction Rows", "x_trades"), ("Internal Ledger Rows", "x_ledger"),
            ("Custodian Balance Rows", "x_custodian"), ("Reconciliation Break Rows", "x_breaks"), ("Exception Log Rows", "x_log")]],
        ("Ledger Roll-Forward Failures", "0", _n("x_rollbreaks"), "{a} = 0"),
        ("Injected Exceptions Tested", "8", _n("x_validation"), "{a} >= 8"),
        ("Injected Exceptions Detected", "8", _n("x_validation", "detection_status = 'DETECTED'"), "{a} >= 8"),
        ("Injection Detection Rate", "1", f"(SELECT round(CAST({_n('x_validation', chr(39).join(['detection_status = ', 'DETECTED', '']))} AS DOUBLE) / {_n('x_validation')}, 4))", "{a} = 1"),
        ("Missing Evidence Count", "0", _n("x_log", "evidence_file IS NULL OR trim(evidence_file) = ''"), "{a} = 0"),
        ("Total Dollar Exposure", "(SELECT round(sum(dollar_exposure), 2) FROM x_log)", "(SELECT round(sum(dollar_exposure), 2) FROM x_log)", "{e} = {a}"),
        ("Cash Break Count", _n("x_recon", "break_type = 'CASH_BALANCE_BREAK'"), _n("x_breaks", "break_category = 'CASH_BALANCE_BREAK'"), "{e} = {a}"),
        ("Share Break Count", _n("x_precon", "break_type = 'SHARE_QUANTITY_BREAK'"), _n("x_breaks", "break_category = 'SHARE_QUANTITY_BREAK'"), "{e} = {a}"),
    ], 1)),
    "dq_null_required": _family("null_required"),
    "dq_duplicate_id": _family("duplicate_id") + " UNION ALL " + _quality_texts(
        QualitySpec("security_transactions.csv", ids=["transaction_id"]), "x_lineids", {"transaction_id", "l_shipdate"}, ["duplicate_id"], 3)[0],
    "dq_invalid_date": _family("invalid_date"),
    "dq_non_numeric": _family("non_numeric"),
    "dq_missing_account": _family("missing_account") + " UNION ALL " + _quality_texts(
        QualitySpec("cash_transactions.csv"), "x_orderaccts", {"account_id"}, ["missing_account"], 2)[0],
    "dq_invalid_status": _family("invalid_status") + " UNION ALL " + " UNION ALL ".join(
        _quality_texts(catalog.FILES_SPEC, "x_registry", _file_cols, ["invalid_status"], 3)),
    "dq_duplicate_rows": _family("duplicate_rows"),
    "dq_critical_null": _family("critical_null"),
    "dq_suite": "SELECT * FROM x_quality",
    "dq_pass_rate": f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE check_status = 'FAIL') AS failed_checks, {_rates.format("count(*) FILTER (WHERE check_status = 'PASS')")} AS pass_rate,
        {', '.join(f"count(*) FILTER (WHERE check_status = 'FAIL' AND severity = '{s}') AS failed_{s.lower()}" for s in ('HIGH', 'MEDIUM', 'LOW'))} FROM x_quality""",
    "column_profile": " UNION ALL ".join(_profile_part(c) for c in RAW_TRANSACTION_COLUMNS),
    "vendor_file_type": "SELECT file_type, count(*) AS files FROM x_vf GROUP BY 1",
    **{k: f"SELECT {_vrow} FROM {rel}" for k, rel in [
        ("vendor_missing", "x_v1"), ("vendor_late", "x_v2"), ("vendor_dup_name", "x_v3"), ("vendor_dup_type_date", "x_v4"),
        ("vendor_count_bounds", "x_v5"), ("vendor_invalid_date", "x_v7"), ("vendor_failed_status", "x_v8")]},
    "vendor_suite": f"SELECT validation_id, {_vrow} FROM x_vendor",
    "vendor_issue_counts": """SELECT 'severity' AS "grouping", severity AS value, count(*) AS issue_count FROM x_vendor GROUP BY severity
        UNION ALL SELECT 'issue_type', issue_type, count(*) FROM x_vendor GROUP BY issue_type""",
    **{k: f"SELECT {_flag_out} FROM {rel}" for k, rel in [
        ("neg_balance", "x_a1"), ("excess_cash", "x_a2"), ("large_movement", "x_a3"), ("statistical_outliers", "x_a4"),
        ("break_concentration_account", "x_a5"), ("break_concentration_category", "x_a6"), ("exception_concentration", "x_a7"), ("large_cash_txn", "x_a8"),
        ("ledger_anomalies", "(SELECT * FROM x_a9 UNION ALL SELECT * FROM x_aa UNION ALL SELECT * FROM x_ab)")]},
    "zscore_outlier": "SELECT account_id, CAST(day AS VARCHAR) AS day, CAST(balance AS DOUBLE) AS balance, round(z, 6) AS z_score FROM x_scored WHERE zo",
    "iqr_outlier": "SELECT account_id, CAST(day AS VARCHAR) AS day, CAST(balance AS DOUBLE) AS balance FROM x_scored WHERE io",
    "anomaly_flags": f"SELECT anomaly_id, {_flag_out} FROM x_flags",
    "anomaly_summary": f"""SELECT anomaly_type, severity, count(*) AS record_count, count(DISTINCT account_id) AS unique_accounts,
        CAST(round(coalesce(sum(amount), 0), 2) AS DOUBLE) AS total_amount, round(CAST(sum(balance) AS DOUBLE) / count(balance), 2) AS avg_balance,
        {_case("anomaly_type", fixed.ANOMALY_ACTIONS, _lit(fixed.DEFAULT_ANOMALY_ACTION))} AS recommended_action FROM x_flags GROUP BY 1, 2""",
    "validation_summary": f"""SELECT '{stand_in.REVIEW_DATE}' AS run_date, {_lit(fixed.ANOMALY_INPUTS)} AS input_file, count(*) AS records_tested, 8 AS checks_performed,
        0 AS failed_checks, count(*) AS anomaly_count, count(*) FILTER (WHERE severity = 'HIGH') AS high_risk_count, CAST(NULL AS DOUBLE) AS pass_rate,
        format('{{:,}}', count(*)) || ' anomaly flags generated for review; ' || format('{{:,}}', count(*) FILTER (WHERE severity = 'HIGH')) || ' HIGH severity' AS notes FROM x_flags
        UNION ALL SELECT '{stand_in.REVIEW_DATE}', {_lit(fixed.VENDOR_INPUTS)}, count(*), 6, count(*), 0, count(*) FILTER (WHERE severity = 'HIGH'),
        CASE WHEN count(*) > 0 THEN 0.0 ELSE 100.0 END, count(*) || ' validation issues; ' || count(*) FILTER (WHERE severity = 'HIGH') || ' HIGH severity' FROM x_vendor
        UNION ALL SELECT '{stand_in.REVIEW_DATE}', {_lit(fixed.QUALITY_INPUTS)}, count(*), count(*), count(*) FILTER (WHERE check_status = 'FAIL'), 0,
        count(*) FILTER (WHERE check_status = 'FAIL' AND severity = 'HIGH'), {_rates.format("count(*) FILTER (WHERE check_status = 'PASS')")},
        count(*) FILTER (WHERE check_status = 'FAIL') || ' of ' || count(*) || ' checks failed; '
        || count(*) FILTER (WHERE check_status = 'FAIL' AND severity = 'HIGH') || ' HIGH severity failures' FROM x_quality""",
}
# The suites run from files must tell what the rules tell of the tables themselves.
SQL |= {"suite_flags": SQL["anomaly_flags"], "suite_flag_summary": SQL["anomaly_summary"], "suite_vendor_issues": SQL["vendor_suite"],
        "suite_quality": SQL["dq_suite"], "suite_summary": SQL["validation_summary"]}


# Whole-number columns that small literals would leave narrower than the Spark side's.
LONG = {
    "seed_if_absent": ["key"],
    "stage_clean": ["flag_invalid_date", "flag_invalid_amount"],
    "cast_failure_flags": ["flag_invalid_date", "flag_invalid_amount"],
    "type_mapping": ["cash_impact_sign", "security_impact_sign", "needs_review"],
    "control_exceptions": ["account_id"],
    "adjustment_counts": ["planned_injections"],
    "exception_completeness": ["missing_evidence_file"],
    "tie_outs": ["check_no"],
    "table_differences": ["source_rows", "copy_rows"],
    **dict.fromkeys(["apply_adjustments", "apply_misposting", "cash_recon", "position_recon", "recon_breaks",
                     "injection_validation", "injection_to_break"], ["injection_id"]),
    **dict.fromkeys([n for n in SQL if n.startswith("dq_") and n != "dq_pass_rate"] + ["suite_quality"], ["check_id"]),
}


def full_text(name: str) -> str:
    """The query's text with every part it uses, each after the parts it uses itself."""
    body, order = SQL[name], []
    if name in LONG:
        body = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in LONG[name])}) FROM ({body})"

    def need(text: str) -> None:
        for part in dict.fromkeys(re.findall(r"\bx_[a-z0-9]+\b", text)):
            if part in PARTS and part not in order:
                need(PARTS[part])
                order.append(part)

    need(body)
    if not order:
        return body
    parts = ", ".join(f"{n} AS ({PARTS[n]})" for n in order)
    own = re.match(r"WITH (.*)", body, re.S)
    return f"WITH {parts}, {own.group(1)}" if own else f"WITH {parts} {body}"


def oracle_sql() -> dict[str, str]:
    return {name: full_text(name) for name in SQL}
