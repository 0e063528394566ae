"""What each layer computes and when."""
