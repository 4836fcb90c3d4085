"""Declared bronze layouts: the columns the operators read, with type and comment."""

from __future__ import annotations

LOAN_APPLICATION = {
    "appl_no": ("bigint", "Application number"), "agree_no": ("bigint", "Loan account number"),
    "cif_no": ("bigint", "Customer id"), "appl_dt": ("bigint", "Application date, yyyymmdd, 0 if missing"),
    "judge_dt": ("bigint", "Decision date, yyyymmdd, 0 if missing"), "status": ("string", "Application status"),
    "channel": ("string", "Application channel"), "score": ("bigint", "Decision score"),
    "rank": ("string", "Score rank"), "decision": ("string", "Score decision"),
    "reject_code": ("string", "Decline reason"), "loan_grp": ("bigint", "Loan group"),
    "fin_amt": ("double", "Financed amount"), "inst_amt": ("double", "Instalment"),
    "interest": ("double", "Interest rate"), "total_inst": ("bigint", "Months"),
    "net_income": ("double", "Net income"), "ndi": ("double", "Disposable income"),
    "cur_dsr": ("double", "Debt service ratio before"), "new_dsr": ("double", "Debt service ratio after"),
    "total_osb": ("double", "Outstanding balance, all products"),
}
CARD_APPLICATION = {
    "appl_id": ("bigint", "Application id"), "account_no": ("bigint", "Card account number"),
    "cif_id": ("bigint", "Customer id"), "appl_dt": ("bigint", "Application date, yyyymmdd, 0 if missing"),
    "judge_dt": ("bigint", "Decision date, yyyymmdd, 0 if missing"), "status": ("string", "Application status"),
    "channel": ("string", "Application channel"), "card_type": ("string", "Card type"),
    "card_brand": ("string", "Card brand"), "decision": ("string", "Score decision"), "rank": ("string", "Score rank"),
    "decline_id": ("bigint", "Decline reason"), "net_income": ("bigint", "Net income"),
    "ndi": ("bigint", "Disposable income"), "cur_dsr": ("bigint", "Debt service ratio before"),
    "new_dsr": ("bigint", "Debt service ratio after"), "cr_limit": ("double", "Approved limit"),
    "final_score": ("bigint", "Final score"), "final_score_desc": ("string", "Final score text"),
}
SALES = {
    "tx_dt": ("bigint", "Transaction date, yyyymmdd"), "cif_no": ("bigint", "Customer id"),
    "ldesc": ("string", "Merchant location"), "grp": ("string", "Merchant group"),
    "sales_type": ("string", "Kind of sale"), "amount": ("double", "Amount"),
    "trans_count": ("bigint", "Transactions, null counts as one"),
}
LOAN_SALES = {**SALES, "tx_dt": ("double", "Transaction date, yyyymmdd as a floating number"),
              "cif_no": ("string", "Customer id as text"), "trans_count": ("double", "Transactions")}
LOAN_COLLECTION = {
    "agree_no": ("bigint", "Loan account number"), "cif_no": ("bigint", "Customer id"),
    "tx_dt": ("bigint", "Reporting date, yyyymmdd"), "branch": ("bigint", "Collection branch"),
    "del_sts": ("bigint", "Delinquency status"), "score_value": ("bigint", "Collection score"),
    "grade": ("string", "Collection grade, A is best"), "sub_code": ("string", "Restructuring code"),
    "finplus": ("string", "Collection tier"), "billing": ("double", "Billed principal"),
    "collection": ("double", "Collected principal"), "unpaid": ("double", "Unpaid principal"),
}
CARD_COLLECTION = {
    "account_no": ("bigint", "Card account number"), "dc_sts": ("bigint", "Delinquency status"),
    **{k: v for k, v in LOAN_COLLECTION.items() if k not in ("agree_no", "del_sts", "sub_code")},
}
CUSTOMER = {
    "cif_id": ("bigint", "Customer id"), "cif_nm": ("string", "Customer name"), "gender": ("string", "Gender"),
    "marital_sts": ("string", "Marital status"), "citizen": ("string", "Citizenship"),
    "state": ("string", "State of residence"), "region": ("string", "Region"), "race": ("string", "Group code"),
    "occupation": ("string", "Occupation"), "nob": ("string", "Nature of business"),
    "emp_sts": ("bigint", "Employment status"), "age": ("bigint", "Age"), "yr_stay": ("bigint", "Years in residence"),
    "yr_job": ("bigint", "Years in job"), "net_income": ("double", "Monthly net income"),
    "gross_income": ("double", "Monthly gross income"), "annual_income": ("double", "Annual income"),
    "recv_promo": ("string", "Marketing consent Y or N"), "rcd_dt": ("date", "Record refresh date"),
}
CARD = {
    "account_no": ("bigint", "Card account number"), "cif_id": ("bigint", "Customer id"),
    "expiry_dt": ("bigint", "Expiry date, yyyymmdd"), "card_status": ("string", "Card status"),
    "akpk": ("string", "Restructured Y or N"), "tier": ("string", "Wallet tier"),
    "cp_cl": ("double", "Purchase limit"), "cp_usage": ("double", "Purchase limit used"),
    "cp_available": ("double", "Purchase limit left"), "ca_cl": ("double", "Cash limit"),
    "ca_usage": ("double", "Cash limit used"),
}

BRONZE = {"loan_app": LOAN_APPLICATION, "loan_sales": LOAN_SALES, "loan_coll": LOAN_COLLECTION,
          "card_app": CARD_APPLICATION, "card_sales": SALES, "card_coll": CARD_COLLECTION, "customer": CUSTOMER,
          "card": CARD}
