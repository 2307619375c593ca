"""Reports over the mart tables: views, audits, cohorts."""
