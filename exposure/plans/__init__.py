"""Relations over the test tables, end-to-end reports, and the registered queries."""
