SELECT * FROM rep_revenue_x
