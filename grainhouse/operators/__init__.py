"""DataFrame operators shared by the warehouse jobs, checks and reports."""
