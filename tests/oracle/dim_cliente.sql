SELECT DISTINCT codcli AS cod_cliente, cliente AS nm_cliente, tipofj AS tipo_pj FROM pcclient
