"""Layouts of the source files: header label, library column name; all read as text."""

from __future__ import annotations

# Header labels of the source files.
TIMESHEET = {
    "Start Date": "start_date", "Start time": "start_time", "End Date": "end_date", "End time": "end_time",
    "Employee Number": "employee_number", "First name": "first_name", "Last name": "last_name",
    "Job": "job", "Employee notes": "employee_notes",
}
# Temporary staff are listed by team instead of by number, in the same place.
TIMESHEET_TEMP = {("Team" if k == "Employee Number" else k): v for k, v in TIMESHEET.items()}
# Labels that may stand for another one: temporary staff have a team for a number.
OTHER_LABELS = {"Team": "Employee Number"}
SCHEDULE = {
    "Date": "sched_date", "Start": "sched_start", "End": "sched_end", "Users": "users",
    "Availability status": "availability_status",
}
PRODUCTION_BONUS = {
    "Date": "bonus_date", "Employee ID": "employee_id", "Silver Bonus": "silver_bonus", "Gold Bonus": "gold_bonus",
}
PAYRATE = {
    "Employee ID": "employee_id", "REG Pay Rate (正常时薪)": "reg_rate", "OT Pay Rate (加班时薪）": "ot_rate",
    "Annual Or Hourly": "pay_basis", "不需要计算": "skip_calc", "Follow 打卡时间": "follow_clock",
    "Bi-weekly 加班费触发小时（有holiday）": "ot_trigger_holiday",
    "Bi-weekly 加班费触发小时（没有holiday）": "ot_trigger_regular",
}
SHEETING = {
    "Paper number (sheet)": "paper_sheets", "Date of filling": "filling_date", "Start time": "start_time",
    "End time": "end_time", "Employee number": "employee_number",
}
DIE_PRICE = {"ERPNum": "erp_num", "ProductID": "product_id", "Price": "price"}
OPERATOR_OUTPUT = {
    "ERPNum": "erp_num", "Product": "product", "Main product code": "main_product_code",
    "Makeup Style": "makeup_style", "Process": "process", "DeviceName": "device_name", "Die Number": "die_number",
    "Actual shift date": "shift_date", "Member ID": "member_id", "Output Qty": "output_qty",
}
BONUS_RATE = {
    "Payroll NO.": "employee_number", "Name": "name", "Location": "location", "Machine": "machine",
    "Silver Rate": "silver_rate", "Gold Rate": "gold_rate",
}
SALES = {
    "OutDate": "out_date", "Sales": "sales", "Customer": "customer", "Product": "product",
    "ProductID": "product_id", "OutCountTotal": "out_count_total", "TotalSales": "total_sales",
    "TotalSales_LocalPrice": "total_sales_local_price",
}
