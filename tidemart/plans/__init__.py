"""Named datasets and jobs: staging, marts, quality checks, reports, churn."""
