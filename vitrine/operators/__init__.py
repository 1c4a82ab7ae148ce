"""DataFrame-to-DataFrame builders of every dataset; none of them runs a job."""
