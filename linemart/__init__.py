"""linemart: batch jobs for reported telecom-line data, as DataFrame-in, DataFrame-out functions."""
