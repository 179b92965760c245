"""paylake: payment-event analytics (Bronze, Silver, Gold and certified queries) on Spark."""
