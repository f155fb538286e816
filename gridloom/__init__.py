"""gridloom: a PySpark engine that turns positioned words and table cells into structured documents."""
