"""Parameters of the registered queries."""

from __future__ import annotations

from clickloom.operators.sessions import SessionFilter

TASK_ID = "task-1"
OTHER_TASK_ID = "task-2"
SAMPLE_SIZE = 100
SAMPLE_SEED = "7"

AGE_FILTER = SessionFilter(start_age=20, end_age=50)
FULL_FILTER = SessionFilter(
    start_age=5,
    end_age=55,
    professionals=("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    cities=tuple(f"city{i}" for i in range(0, 20)),
    sex="male",
    keywords=("kw1", "kw3", "kw5", "kw7"),
    category_ids=(1, 2, 3, 5, 8, 13),
)
