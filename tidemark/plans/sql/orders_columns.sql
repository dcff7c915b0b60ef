CREATE TABLE orders (
    o_orderkey DECIMAL(12,0) NOT NULL,
    o_orderdate DATE,
    o_totalprice DECIMAL(12,1),
    o_orderstatus STRING
)
