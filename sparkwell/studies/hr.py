"""Employees with their salary, title and department histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwell import views
from sparkwell.operators.windows import latest
from sparkwell.registry import query


def all_info(employees: DataFrame, salaries: DataFrame, titles: DataFrame) -> DataFrame:
    """Each salary record with the title of the same record and the employee's name.

    Histories meet record by record; pairing every salary of an employee with every title
    would square the length of the longest history.
    """
    records = salaries.join(titles, ["emp_no", "id", "to_date"])
    return records.join(employees, "emp_no").select("emp_no", "name", "id", "to_date", "salary", "title")


def latest_record(employees: DataFrame, salaries: DataFrame, titles: DataFrame, departments: DataFrame) -> DataFrame:
    """One row per employee. Each history is reduced first; all four are then hashed alike."""
    return (
        employees.join(latest(salaries, "emp_no", "salary", "last_salary"), "emp_no")
        .join(latest(titles, "emp_no", "title", "last_title"), "emp_no")
        .join(latest(departments, "emp_no", "dept_no", "last_dept"), "emp_no")
        .orderBy("emp_no")
    )


@query(
    "hr_all_info",
    """SELECT e.emp_no, e.name, s.id, s.to_date, s.salary, t.title FROM v_employees e
       JOIN v_salaries s ON s.emp_no = e.emp_no
       JOIN v_titles t ON t.emp_no = s.emp_no AND t.id = s.id AND t.to_date = s.to_date""",
)
def hr_all_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_info(views.employees(spark, sf_dir), views.salaries(spark, sf_dir), views.titles(spark, sf_dir))


@query(
    "hr_latest",
    """SELECT emp_no, name, last_salary, last_title, last_dept FROM v_employees JOIN v_last_salary USING (emp_no)
       JOIN v_last_title USING (emp_no) JOIN v_last_dept USING (emp_no)""",
)
def hr_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_record(
        views.employees(spark, sf_dir),
        views.salaries(spark, sf_dir),
        views.titles(spark, sf_dir),
        views.dept_emp(spark, sf_dir),
    )
