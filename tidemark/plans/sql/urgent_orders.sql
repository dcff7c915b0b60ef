DELETE FROM orders WHERE o_orderpriority = '1-URGENT';
