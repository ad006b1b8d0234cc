"""The feed contract: one list from which schemas, renames and clean-up follow."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeeper.functions import codes, dates, text

# The provider's header, the short name used inside a run, the
# history column, the history type, and how the value is cleaned on the way in.
PEOPLE_FEED = """
File Number | file_number | file_no | string | keep
Carthage ID # | carth_id | carthage_id | int | keep
Last Name | last_name | lastname | string | keep
First Name | first_name | firstname | string | keep
Middle Name | middle_name | middlename | string | keep
Salutation | salutation | salutation | string | keep
Payroll Name | payroll_name | fullname | string | keep
Preferred Name | preferred_name | pref_name | string | keep
Birth Date | birth_date | birth_date | date | date
Gender | gender | gender | string | left(1)
Marital Status Code | marital_status | marital_status | string | keep
Race Code | race | race | string | race_code
Race Description | race_descr | race_descr | string | left(24)
Ethnicity | ethnicity | hispanic | string | hispanic_flag
Ethnicity/Race ID Method | ethnicity_id_meth | race_id_method | string | keep
Personal Contact: Personal Email | personal_email | personal_email | string | left(64)
Primary Address: Address Line 1 | primary_address1 | primary_addr_line1 | string | left(64)
Primary Address: Address Line 2 | primary_address2 | primary_addr_line2 | string | left(64)
Primary Address: Address Line 3 | primary_address3 | primary_addr_line3 | string | left(64)
Primary Address: City | primary_city | primary_addr_city | string | keep
Primary Address: State / Territory Code | primary_state_code | primary_addr_st | string | left(2)
Primary Address: State / Territory Description | primary_state_descr | primary_addr_state | string | keep
Primary Address: Zip / Postal Code | primary_zip | primary_addr_zip | string | keep
Primary Address: County | primary_county | primary_addr_county | string | keep
Primary Address: Country | primary_country | primary_addr_country | string | left(25)
Primary Address: Country Code | primary_country_code | primary_addr_country_code | string | left(3)
Primary Address: Use as Legal / Preferred Address | primary_legal_address | primary_addr_as_legal | string | left(1)
Personal Contact: Home Phone | home_phone | home_phone | string | phone
Personal Contact: Personal Mobile | mobile_phone | cell_phone | string | phone
Work Phone | work_phone | work_phone | string | phone
Work Contact: Work Phone | wc_work_phone | work_contact_phone | string | phone
Work Contact: Work Email | wc_work_email | work_contact_email | string | keep
Work Contact: Use Work Email for Notification | use_work_for_notification | work_contact_notification | string | left(1)
Legal / Preferred Address: Address Line 1 | legal_address1 | legal_addr_line1 | string | left(64)
Legal / Preferred Address: Address Line 2 | legal_address2 | legal_addr_line2 | string | left(64)
Legal / Preferred Address: Address Line 3 | legal_address3 | legal_addr_line3 | string | left(64)
Legal / Preferred Address: City | legal_city | legal_addr_city | string | keep
Legal / Preferred Address: State / Territory Code | legal_state_code | legal_addr_st | string | left(2)
Legal / Preferred Address: State / Territory Description | legal_state_description | legal_addr_state | string | keep
Legal / Preferred Address: Zip / Postal Code | legal_zip | legal_addr_zip | string | keep
Legal / Preferred Address: County | legal_county | legal_addr_county | string | keep
Legal / Preferred Address: Country | legal_country | legal_addr_country | string | left(25)
Legal / Preferred Address: Country Code | legal_country_code | legal_addr_country_code | string | left(3)
Tax ID (SSN) | ssn | ssn | string | keep
Hire Date | hire_date | hire_date | date | date
Hire Date/Rehire Date | hire_rehire_date | hire_rehire_date | date | date
Rehire Date | rehire_date | rehire_date | date | date
Position Start Date | pos_start_date | position_start_date | date | date
Position Effective Date | pos_effective_date | position_effective_date | date | date
Position Effective End Date | pos_effective_end_date | position_effective_end_date | date | date
Termination Date | termination_date | termination_date | date | date
Position Status | position_status | position_status | string | keep
Status Effective Date | status_effective_date | status_effective_date | date | date
Status Effective End Date | status_eff_end_date | status_effective_end_date | date | date
Adjusted Service Date | adj_service_date | adjusted_service_date | date | date
Archived Employee | archived | archived_employee | string | keep
Position ID | position_id | position_id | string | keep
Primary Position | primary_position | primary_position | string | keep
Payroll Company Code | payroll_comp_code | payroll_company_code | string | keep
Payroll Company Name | payroll_comp_name | payroll_company_name | string | keep
CIP Code | cip | cip_code | string | keep
Worker Category Code | worker_cat_code | worker_category_code | string | left(4)
Worker Category Description | worker_cat_descr | worker_category_descr | string | left(64)
Job Title Code | job_title_code | job_title_code | string | left(3)
Job Title Description | job_title_descr | job_title_descr | string | left(125)
Home Cost Number Code | home_cost_code | home_cost_number_code | string | keep
Home Cost Number Description | home_cost_descr | home_cost_number_descr | string | keep
Job Class Code | job_class_code | job_class_code | string | left(2)
Job Class Description | job_class_descr | job_class_descr | string | keep
Job Description | job_description | job_descr | string | keep
Job Function Code | job_function_code | job_function_code | string | keep
Job Function Description | job_function_description | job_function_descr | string | keep
Room Number | room_number | room | string | left(4)
Location Code | location_code | bldg | string | left(4)
Location Description | location_description | bldg_name | string | left(24)
Leave of Absence Start Date | leave_start_date | leave_of_absence_start_date | date | date
Leave of Absence Return Date | leave_return_date | leave_of_absence_return_date | date | date
Home Department Code | home_dept_code | home_depart_num_code | string | keep
Home Department Description | home_dept_descr | home_depart_num_descr | string | keep
Supervisor ID | supervisor_id | supervisor_id | string | keep
Supervisor First Name | supervisor_fname | supervisor_firstname | string | keep
Supervisor Last Name | supervisor_lname | supervisor_lastname | string | keep
Business Unit Code | business_unit_code | business_unit_code | string | zero_pad(3)
Business Unit Description | business_unit_descr | business_unit_descr | string | keep
Reports To Name | reports_to_name | reports_to_name | string | keep
Reports To Position ID | reports_to_pos_id | reports_to_position_id | string | keep
Reports To Associate ID | reports_to_assoc_id | reports_to_associate_id | string | keep
Associate ID | employee_assoc_id | employee_associate_id | string | keep
This is a Management position | management_position | management_position | string | keep
Supervisor Position | supervisor_flag | supervisor_flag | string | left(4)
Directory Job Title | long_title | long_title | string | keep
"""

STAMP = "date_stamp"
STAMP_DAY = "stamp_day"
CORRUPT = "_corrupt_record"

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "date": T.DateType()}


@dataclass(frozen=True)
class Field:
    header: str
    name: str
    history: str
    type: str
    cleanup: str

    @property
    def is_date(self) -> bool:
        return self.type == "date"

    def clean(self, c: Column) -> Column:
        """The cleaned value: a date for date fields, otherwise text."""
        kind, arg = re.fullmatch(r"(\w+)(?:\((\d+)\))?", self.cleanup).groups()
        if kind == "keep":
            return c
        if kind == "left":
            return text.cut(c, int(arg))
        if kind == "zero_pad":
            return text.zero_pad(c, int(arg))
        return {
            "date": dates.feed_date,
            "phone": text.phone,
            "race_code": codes.race_code,
            "hispanic_flag": codes.hispanic_flag,
        }[kind](c)

    def stored(self, c: Column) -> Column:
        """The cleaned value in the type the history keeps."""
        return c.try_cast("int") if self.type == "int" else c

    def short(self, c: Column) -> Column:
        """The stored value as a run compares it: text trimmed, ids as text."""
        return c if self.is_date else F.trim(c.cast("string"))


class Contract:
    """An ordered list of fields, with the renames and schemas made from it."""

    def __init__(self, table: str):
        self.fields = [
            Field(*(part.strip() for part in line.split(" | ")))
            for line in table.strip().splitlines()
        ]

    @property
    def headers(self) -> list[str]:
        return [f.header for f in self.fields]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def history_names(self) -> list[str]:
        return [f.history for f in self.fields]

    @property
    def date_fields(self) -> list[Field]:
        return [f for f in self.fields if f.is_date]

    def history_schema(self) -> T.StructType:
        columns = [T.StructField(f.history, _TYPES[f.type]) for f in self.fields]
        return T.StructType([*columns, T.StructField(STAMP, T.TimestampType())])

    def check_headers(self, present: list[str]) -> None:
        missing = [h for h in self.headers if h not in present]
        if missing:
            raise ValueError(f"feed lacks columns: {missing}")

    def to_history(self, df: DataFrame) -> DataFrame:
        """Short names to history names and types."""
        return df.select(*[f.stored(F.col(f.name)).alias(f.history) for f in self.fields])

    def unpadded(self, history: DataFrame) -> DataFrame:
        """History rows without the padding of a fixed-width store; the stamp is kept, and its day if files lie by it."""
        columns = [
            F.rtrim(F.col(f.history)).alias(f.history) if f.type == "string" else F.col(f.history)
            for f in self.fields
        ]
        return history.select(*columns, STAMP, *[c for c in (STAMP_DAY,) if c in history.columns])

    def from_history(self, df: DataFrame) -> DataFrame:
        """History names to short names, text trimmed, ids as text."""
        return df.select(*[f.short(F.col(f.history)).alias(f.name) for f in self.fields])

    def to_feed(self, df: DataFrame) -> DataFrame:
        """Short names to the provider's headers, everything as text."""
        return df.select(
            *[
                (dates.iso_text(F.col(f.name)) if f.is_date else F.col(f.name)).alias(f.header)
                for f in self.fields
            ]
        )


PEOPLE = Contract(PEOPLE_FEED)
