"""Jobs: compositions of operators from raw tables to model reports."""
