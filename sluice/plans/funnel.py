"""From raw customer-keyed tables to a funnel table, a model and a report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sluice.operators.clean import absent_columns, drop_columns, rename_columns, trim_names
from sluice.operators.evaluate import funnel_effectiveness
from sluice.operators.joins import join_on_key
from sluice.operators.models import Recipe, fit
from sluice.operators.profile import drop_duplicates
from sluice.operators.split import split

KEY = "Customer_ID"
STATUS = "Conversion_Status"

# Column names the funnel tables come with.
MARKETING_DROPS = ("Device_Type", "_c9")
MARKETING_RENAMES = {
    "Email_Open_Rate(%)": "Email_open_rate",
    "Click-Through_Rate_on_open_email_(%)": "click_through_rate",
}
SALES_DROPS = ("Order_ID",)
SALES_RENAMES = {
    "Interest_Rates_(%)": "Interest_rate",
    "Time_to_purchase(Days)": "Days_to_purchase",
}
# Identifiers, dates and columns known only after the outcome,
# none of which may predict it.
NOT_PREDICTORS = (
    "Lead_ID", "Customer_ID", "Lead_Owner", "Lead_Generated", "Lead_Closed",
    "Lead_Closed_In_Days", "First_Name", "Last_Name", "Education_Level", "Touchpoint",
    "Email_Open_Rate", "Click-Through_Rate_on_open_email", "Website_Visits",
    "Previous_Product_Type", "Start_Date", "Closure_Date", "Tenure_in_Months",
    "Interest_Rates", "EMI", "Payment_Method", "Referral_Channel", "Device_Type",
)
# The categorical predictors, trimmed.
CATEGORIES = (
    "Lead_Source", "Account_Type", "Product/Service_Interest", "Location", "City", "Gender",
    "Maritial_Status", "Property_Ownership", "Profession", "Loan_Status",
)


def clean_marketing(raw: DataFrame) -> DataFrame:
    """Drop the device and the blank column, merge duplicate rows, shorten names."""
    kept = drop_columns(trim_names(raw), MARKETING_DROPS, strict=False)
    return rename_columns(drop_duplicates(kept), MARKETING_RENAMES, strict=False)


def clean_sales(raw: DataFrame) -> DataFrame:
    """Drop the order number, merge duplicate rows, shorten names."""
    kept = drop_columns(trim_names(raw), SALES_DROPS, strict=False)
    return rename_columns(drop_duplicates(kept), SALES_RENAMES, strict=False)


def funnel_table(crm: DataFrame, external: DataFrame, marketing: DataFrame,
                 sales: DataFrame) -> DataFrame:
    """One row per combination of a customer's rows in the four tables."""
    return join_on_key([crm, external, marketing, sales], KEY)


def model_table(funnel: DataFrame) -> tuple[DataFrame, list[str]]:
    """The predictors and the label, and which of the unwanted columns were absent."""
    named = trim_names(funnel)
    return (drop_columns(named, NOT_PREDICTORS, strict=False),
            absent_columns(named, NOT_PREDICTORS))


def effectiveness_report(leads: DataFrame, recipe: Recipe, keys: Sequence[str] = (KEY,),
                         by: Sequence[str] = ()) -> DataFrame:
    """Train on the training split, report effectiveness on the test split."""
    train, _, test = split(leads, keys)
    return funnel_effectiveness(fit(recipe, train).score(test), "predicted_status", *by)
